"""Hand-computed values for the quirks of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.functions import clinical as c
from carelake.functions import dates as d
from carelake.functions import nulls as n
from carelake.functions import prices as p
from carelake.functions import text as t
from carelake.functions.geo import projected_population, utm37s


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head()["v"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "fn, start, end, expected",
    [
        (d.year_diff, "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        (d.year_diff, "2024-01-01 00:00:00", "2024-12-31 00:00:00", 0),
        (d.day_diff, "2024-01-01 23:59:00", "2024-01-02 00:01:00", 1),
        (d.day_diff, "2024-01-03 00:00:00", "2024-01-01 23:00:00", -2),
        (d.hour_diff, "2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
        (d.hour_diff, "1969-12-31 23:30:00", "1970-01-01 00:10:00", 1),
        (d.minute_diff, "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        (d.minute_diff, "2024-01-01 00:01:00", "2024-01-01 00:01:59", 0),
    ],
)
def test_boundaries_crossed(spark, fn, start, end, expected):
    assert one(spark, fn(ts(start), ts(end))) == expected


def test_dates(spark):
    assert one(spark, d.week_start(ts("2024-01-07 10:00:00"))) == dt.date(2024, 1, 1)
    assert one(spark, d.add_months(ts("2024-05-31 00:00:00"), -3)) == dt.date(2024, 2, 29)
    assert one(spark, d.epoch_local(F.lit(1704067200))) == dt.datetime(2024, 1, 1, 3)
    assert one(spark, d.epoch_local(F.lit(1704067200123))) == dt.datetime(2024, 1, 1, 3, 0, 0, 123000)
    assert one(spark, d.epoch_local(F.lit(10_000_000_000))) == dt.datetime(2286, 11, 20, 20, 46, 40)


def test_nulls(spark):
    none = F.lit(None).cast("double")
    assert one(spark, n.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, n.strict_greatest(F.lit(1.0), none)) is None
    assert one(spark, n.strict_least(F.lit(1.0), F.lit(2.0))) == 1.0
    assert one(spark, n.blank_to_null(F.lit("  "))) is None


def test_event_labels(spark):
    assert one(spark, c.event_category(F.lit("admin_payment"))) == "FINANCIAL"
    assert one(spark, c.event_category(F.lit("PAYMENT"))) == "OTHER"
    amount, when = F.lit(None).cast("decimal(38,2)"), F.lit(None).cast("timestamp_ntz")
    assert one(spark, c.validation_status(amount, when)) == "MISSING_AMOUNT"
    assert one(spark, c.validation_status(F.lit(1), when)) == "INVALID_TIMESTAMP"


@pytest.mark.parametrize(
    "bmi, label",
    [(18.49, "Underweight"), (18.5, "Normal"), (24.9, "Normal"), (24.95, "Unknown"), (29.95, "Unknown"),
     (30.0, "Obese Class I"), (40.0, "Obese Class III"), (None, "Unknown")],
)
def test_bmi_classes(spark, bmi, label):
    assert one(spark, c.classify_bmi(F.lit(bmi).cast("double"))) == label


def test_bmi_zero_height(spark):
    assert one(spark, c.bmi(F.lit(70), F.lit(0))) is None
    assert one(spark, c.bmi(F.lit(81), F.lit(180))) == pytest.approx(25.0)


@pytest.mark.parametrize(
    "days, band",
    [(0, "Same Day"), (1, "1 Day"), (3, "2-3 Days"), (7, "4-7 Days"), (14, "1-2 Weeks"), (30, "2-4 Weeks"),
     (31, "> 4 Weeks"), (-1, "> 4 Weeks")],
)
def test_los_bands(spark, days, band):
    start = F.lit("2024-01-10").cast("date")
    assert one(spark, c.los_band(start, F.date_add(start, days))) == band
    assert one(spark, c.los_band(start, F.lit(None).cast("date"))) == "Unknown"


def test_age_labels(spark):
    as_of = "2024-01-31"
    for year, label in [(2024, "Infant"), (2023, "Toddler"), (2019, "Child"), (2011, "Adolescent"), (2006, "Young Adult"),
                        (1984, "Middle Age"), (1959, "Senior")]:
        assert one(spark, c.age_label(F.lit(f"{year}-06-01").cast("date"), as_of)) == label
    assert one(spark, c.patient_age_group(F.lit(None).cast("date"), as_of)) == "GERIATRIC"
    assert one(spark, c.report_age_band(F.lit(40))) == "Young Adult"


def test_risk(spark):
    assert one(spark, c.readmission_risk(F.lit(40), F.lit("M"), F.lit(1), F.lit(1), F.lit(2), F.lit(10000))) == 59.0
    assert one(spark, c.readmission_risk(F.lit(90), F.lit("F"), F.lit(9), F.lit(9), F.lit(9), F.lit(0))) == 100.0
    assert one(spark, c.readmission_risk(F.lit(90), F.lit("F"), F.lit(None), F.lit(9), F.lit(9), F.lit(0))) is None


def test_sql_functions_equal_columns(spark):
    assert len(c.register_sql_functions(spark)) == 5
    got = spark.sql("""SELECT fn_classify_bmi(24.95) a, fn_calculate_los_band(DATE '2024-01-10', DATE '2024-01-09') b,
        fn_calculate_bmi(70, 0) c, fn_extract_age_group(NULL, DATE '2024-01-01') d,
        fn_calculate_readmission_risk(40, 'M', 1, 1, 2, 10000) e""").head()
    assert tuple(got) == ("Unknown", "> 4 Weeks", None, "Unknown", 59.0)


def test_discharge_and_stock(spark):
    assert one(spark, c.discharge_category(F.lit("home"), F.lit(24))) == "HOME_DISCHARGE"
    assert one(spark, c.discharge_category(F.lit("home"), F.lit(None).cast("int"))) == "OTHER"
    assert one(spark, c.stock_status(F.lit(0), F.lit(0))) == "OUT_OF_STOCK"
    assert one(spark, c.stock_status(F.lit(3), F.lit(2))) == "OVERSTOCKED"
    assert one(spark, c.days_of_supply(F.lit(3), F.lit(0))) is None
    assert one(spark, c.recency_status(F.lit("2024-02-29").cast("date"), "2024-05-31 00:00:00")) == "ACTIVE"


@pytest.mark.parametrize(
    "fn, text, value",
    [
        (p.price_first, "KSh 1,234.50 (was 2,000)", 1234.5),
        (p.price_first, "no price", None),
        (p.price_first, ", 5", None),
        (p.price_kes, "3 for kes 99", 99.0),
        (p.price_kes, "only 45.", 45.0),
        (p.price_digits, "KES 1.2.3", 1.2),
        (p.price_digits, ".5 off", 0.5),
        (p.price_digits, "..", None),
        (p.price_digits, "abc", None),
    ],
)
def test_prices(spark, fn, text, value):
    assert one(spark, fn(F.lit(text))) == value


def test_discount_and_swap(spark):
    assert one(spark, p.discount_pct(F.lit(75.0), F.lit(100.0))) == 25.0
    assert one(spark, p.discount_pct(F.lit(0.0), F.lit(100.0))) is None
    current, original = p.price_swap(F.lit(None).cast("double"), F.lit(9.0))
    assert (one(spark, current), one(spark, original)) == (9.0, None)


def test_text(spark):
    lit = F.lit
    assert one(spark, t.model_namespace(lit("Core"), lit("core_approvals"))) == r"Ignite\Core\Entities\Approvals"
    assert one(spark, t.model_namespace(lit("core"), lit("core_approvals"), True)) == r"Ignite\Core\Entities\CoreApprovals"
    assert one(spark, t.model_namespace(lit("Finance Dept"), lit("waiver_items"))) == r"Ignite\FinanceDept\Entities\WaiverItems"
    assert one(spark, t.safe_token(lit(" a b/c:d+e=f.g "))) == "a_b_c_d+e=f.g"
    assert one(spark, t.safe_filename(lit("a/b\\c"))) == "a_b_c"
    assert one(spark, t.place_name(lit("https://x/maps/place/Shop+No%201%2B/z"))) == "Shop No 1 "
    assert one(spark, t.place_name(lit("https://x/maps/"))) == ""
    assert one(spark, t.place_name(lit("https://x/place/50%+off/"))) == "50% off"
    assert one(spark, t.phone_suffix(lit("phone:tel:+254"))) == "+254"
    assert one(spark, t.file_stem(ts("2024-01-02 03:04:05"), lit(None).cast("string"), lit("j1"))) == "20240102_030405_job_j1"


def test_geo(spark):
    # A short step east and north must be as long in metres as on the sphere.
    east, north = utm37s(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame([(36.80, -1.29), (36.81, -1.29), (36.80, -1.28), (39.0, 0.0)], "lon double, lat double")
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = [tuple(r) for r in df.select(east, north).collect()]
    assert ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5 == pytest.approx(1112.9, rel=2e-3)
    assert ((x2 - x0) ** 2 + (y2 - y0) ** 2) ** 0.5 == pytest.approx(1105.7, rel=2e-3)
    assert (x3, y3) == pytest.approx((500000.0, 10000000.0), abs=1e-6)
    assert one(spark, projected_population(F.lit(43122))) == int(43122 * 1.042**7)
    assert one(spark, projected_population(F.lit(43122), F.lit(0))) == 0


def test_numbers_and_dates_of_sheets(spark):
    from carelake.operators.sheet import coerce_date, coerce_mixed, coerce_numeric

    numbers = {"45F": 0.0, "12d": 0.0, "1.5f": 0.0, " 7 ": 7.0, "-1e3": -1000.0, ".5": 0.5, "5.": 5.0, "NaN": 0.0, "0x1A": 0.0, "1_000": 0.0, "inf": float("inf"), None: 0.0}
    df = spark.createDataFrame([(k, k) for k in numbers], "los string, age_or_dob string")
    assert {r.age_or_dob: r.los for r in coerce_numeric(df).collect()} == numbers
    assert {r.los: r.age_or_dob for r in coerce_mixed(df).collect()}["45F"] == "45F"
    days = ["2024-01-02T03:04:05", "1/2/2024", "02-Jan-2024", "20240102", "2024-1-2", "2024-01-02 03:04:05.123", "2024-01-02T23:04:05+03:00", "2024-01-02T03:04:05Z",
            "January 2, 2024", "Jan 2, 2024", "2 Jan 2024", "2 January 2024", "2024/01/02", "01/02/2024", "1/2/2024 3:04", " 2024-01-02 "]
    read = coerce_date(spark.createDataFrame([(d,) for d in [*days, "unknown", "2024-13-02", "45F", None]], "adm_date string"))
    assert [r.adm_date for r in read.collect()] == ["2024-01-02"] * len(days) + [None] * 4
