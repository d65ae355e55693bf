"""Labels, bands and scores, as Columns and as Spark SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .dates import add_months, as_of_column, day, year_diff
from .nulls import safe_div, strict_greatest, strict_least


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _first_match(pairs, default) -> Column:
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default)


def event_category(event_type) -> Column:
    t = _c(event_type)
    # Substring -> category, first match wins.
    words = [("payment", "FINANCIAL"), ("clinical", "CLINICAL"), ("admin", "ADMINISTRATIVE")]
    return _first_match([(t.contains(w), c) for w, c in words], "OTHER")


def validation_status(amount, event_time) -> Column:
    return (
        F.when(_c(amount).isNull(), "MISSING_AMOUNT")
        .when(_c(event_time).isNull(), "INVALID_TIMESTAMP")
        .otherwise("VALID")
    )


def patient_age_group(birth_date, as_of) -> Column:
    """Three bands; an unknown birth date falls to the last one."""
    age = year_diff(birth_date, as_of_column(as_of))
    return F.when(age < 18, "PEDIATRIC").when(age.between(18, 65), "ADULT").otherwise("GERIATRIC")


def report_age_band(age) -> Column:
    a = _c(age)
    return (
        F.when(a < 18, "Pediatric")
        .when(a.between(18, 40), "Young Adult")
        .when(a.between(41, 65), "Middle Age")
        .otherwise("Geriatric")
    )


def discharge_category(disposition, los_hours) -> Column:
    d, los = _c(disposition), _c(los_hours)
    return (
        F.when(d.isin("expired", "hospice"), "MORTALITY")
        .when((d == "home") & (los < 24), "SHORT_STAY")
        .when((d == "home") & (los >= 24), "HOME_DISCHARGE")
        .when(d.isin("skilled_nursing", "rehab"), "POST_ACUTE")
        .otherwise("OTHER")
    )


def appointment_outcome(event_type, next_event_type) -> Column:
    booked = _c(event_type) == "appointment"
    nxt = _c(next_event_type)
    return (
        F.when(booked & (nxt == "encounter"), "COMPLETED")
        .when(booked & nxt.isNull(), "PENDING")
        .when(booked & (nxt != "encounter"), "NO_SHOW")
        .otherwise("OTHER")
    )


def recency_status(last_visit, as_of) -> Column:
    seen, today = day(last_visit), as_of_column(as_of)
    return (
        F.when(seen >= add_months(today, -3), "ACTIVE")
        .when(seen >= add_months(today, -12), "INACTIVE")
        .otherwise("LAPSED")
    )


def stock_status(stock, usage) -> Column:
    s, u = _c(stock), _c(usage)
    return (
        F.when(s <= 0, "OUT_OF_STOCK")
        .when(s < u * F.lit("0.5").cast("decimal(2,1)"), "LOW_STOCK")
        .when(s < u * F.lit("1.5").cast("decimal(2,1)"), "ADEQUATE")
        .otherwise("OVERSTOCKED")
    )


def days_of_supply(stock, usage) -> Column:
    return safe_div(_c(stock).cast("double"), _c(usage).cast("double") / 30)


def bmi(weight_kg, height_cm) -> Column:
    metres = _c(height_cm).cast("double") / 100
    return safe_div(_c(weight_kg).cast("double"), F.pow(metres, F.lit(2)))


# BMI classes with their literal closed ranges; what lies between
# two ranges (24.95) is Unknown.
BMI_RANGES = [
    (18.5, 24.9, "Normal"),
    (25.0, 29.9, "Overweight"),
    (30.0, 34.9, "Obese Class I"),
    (35.0, 39.9, "Obese Class II"),
]
BMI_LOW = (18.5, "Underweight")
BMI_HIGH = (40.0, "Obese Class III")

# Upper age bound (exclusive) -> label.
AGE_LABELS = [
    (1, "Infant"),
    (5, "Toddler"),
    (13, "Child"),
    (18, "Adolescent"),
    (40, "Young Adult"),
    (65, "Middle Age"),
]
AGE_LAST = "Senior"

# First day, last day -> length-of-stay band.
LOS_BANDS = [
    (0, 0, "Same Day"),
    (1, 1, "1 Day"),
    (2, 3, "2-3 Days"),
    (4, 7, "4-7 Days"),
    (8, 14, "1-2 Weeks"),
    (15, 30, "2-4 Weeks"),
]
LOS_LAST = "> 4 Weeks"


def classify_bmi(value) -> Column:
    b = _c(value)
    pairs = [(b < BMI_LOW[0], BMI_LOW[1])]
    pairs += [(b.between(lo, hi), label) for lo, hi, label in BMI_RANGES]
    pairs += [(b >= BMI_HIGH[0], BMI_HIGH[1])]
    return _first_match(pairs, "Unknown")


def age_label(birth_date, as_of) -> Column:
    age = year_diff(birth_date, as_of_column(as_of))
    pairs = [(_c(birth_date).isNull(), "Unknown")]
    pairs += [(age < bound, label) for bound, label in AGE_LABELS]
    return _first_match(pairs, AGE_LAST)


def los_band(admit, discharge) -> Column:
    days = F.datediff(day(discharge), day(admit))
    pairs = [(days.isNull(), "Unknown")]
    pairs += [(days.between(lo, hi), label) for lo, hi, label in LOS_BANDS]
    return _first_match(pairs, LOS_LAST)


def readmission_risk(age, gender, prior, chronic, avg_los, charges) -> Column:
    """Weighted sum clamped to 0..100; NULL as soon as a number is NULL."""
    num = [_c(c).cast("double") for c in (age, prior, chronic, avg_los, charges)]
    a, p, ch, los, total = num
    score = (
        a * 0.5
        + F.when(_c(gender) == "M", 5.0).otherwise(3.0)
        + p * 10
        + ch * 15
        + los * 2
        + (total / 10000) * 5
    )
    return strict_least(F.lit(100.0), strict_greatest(F.lit(0.0), score))


def _sql_case(pairs, default) -> str:
    body = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in pairs)
    return f"CASE {body} ELSE '{default}' END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the scalar functions as temporary Spark SQL functions.

    They are SQL bodies, so Catalyst inlines them: no Python runs per row.
    """
    bmi_case = _sql_case(
        [(f"bmi < {BMI_LOW[0]}D", BMI_LOW[1])]
        + [(f"bmi BETWEEN {lo}D AND {hi}D", label) for lo, hi, label in BMI_RANGES]
        + [(f"bmi >= {BMI_HIGH[0]}D", BMI_HIGH[1])],
        "Unknown",
    )
    years = "(year(as_of) - year(birth_date))"
    age_case = _sql_case(
        [("birth_date IS NULL", "Unknown")] + [(f"{years} < {b}", label) for b, label in AGE_LABELS],
        AGE_LAST,
    )
    stay = "datediff(discharge_date, admit_date)"
    los_case = _sql_case(
        [(f"{stay} IS NULL", "Unknown")]
        + [(f"{stay} BETWEEN {lo} AND {hi}", label) for lo, hi, label in LOS_BANDS],
        LOS_LAST,
    )
    risk = (
        "age * 0.5D + if(gender = 'M', 5.0D, 3.0D) + prior_admissions * 10 "
        "+ chronic_conditions * 15 + avg_los * 2 + (total_charges / 10000) * 5"
    )
    functions = {
        "fn_calculate_bmi(weight_kg DOUBLE, height_cm DOUBLE) RETURNS DOUBLE":
            "try_divide(weight_kg, power(height_cm / 100, 2))",
        "fn_classify_bmi(bmi DOUBLE) RETURNS STRING": bmi_case,
        "fn_extract_age_group(birth_date DATE, as_of DATE) RETURNS STRING": age_case,
        "fn_calculate_los_band(admit_date DATE, discharge_date DATE) RETURNS STRING": los_case,
        "fn_calculate_readmission_risk(age DOUBLE, gender STRING, prior_admissions DOUBLE, "
        "chronic_conditions DOUBLE, avg_los DOUBLE, total_charges DOUBLE) RETURNS DOUBLE":
            f"CASE WHEN ({risk}) IS NOT NULL THEN least(100.0D, greatest(0.0D, {risk})) END",
    }
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in functions]
