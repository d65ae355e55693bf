"""Hand-computed cases of the datasets and properties of their plans."""

import datetime as dt
import json

from pyspark.sql import functions as F

from carelake.fixtures import AS_OF
from carelake.operators.spatial import join_radius
from carelake.plans.clinical import clinical_metrics, encounter_metrics, median_by
from carelake.plans.market import market_dna
from carelake.plans.mart import daily_facility_metrics, dim_patient, fact_encounters, monthly_report, readmission_rates
from carelake.plans.patients import patient_360
from carelake.plans.quality import latency_alert, quality_checks
from carelake.plans.revenue import daily_kpis
from carelake.plans.sheet import clean_sheet
from carelake.registry import queries
from carelake.registry.aggregates import labelled
from carelake.sources.bucketed import largest_share, write_bucketed
from conftest import SF_DIR, rows

ENCOUNTERS = """encounter_id string, patient_id string, provider_id string, department_id string, facility_id string, encounter_type string,
    admit_ts timestamp_ntz, discharge_ts timestamp_ntz, discharge_disposition string, total_charges decimal(38,2), payment_status string"""


def encounters(spark, *data):
    cells = [(e, p, "v", dep, "f", kind, a, d, disp, None, "paid") for e, p, dep, kind, a, d, disp in data]
    return spark.createDataFrame(cells, ENCOUNTERS)


def at(day, hour=0, month=1):
    return dt.datetime(2024, month, day, hour)


def test_clinical(spark):
    enc = encounters(
        spark, ("1", "a", "x", "in", at(1), at(1, 5), "home"), ("2", "a", "x", "in", at(1), at(3), "home"),
        ("3", "b", None, "in", at(1), None, "rehab"), ("4", "b", None, None, at(2), at(1), "hospice"),
    )
    diag = spark.createDataFrame([("1", "B", True), ("1", "A", True), ("1", "A", None)], "encounter_id string, diagnosis_code string, present_on_admission boolean")
    proc = spark.createDataFrame([("1", "P"), ("1", "P"), ("1", "Q")], "encounter_id string, procedure_code string")
    got = {r.encounter_id: r for r in clinical_metrics(enc, diag, proc).collect()}
    # Procedures do not multiply diagnosis counts; copies of a code count once.
    assert (got["1"].diagnosis_count, got["1"].diagnosis_codes, got["1"].poa_diagnosis_count, got["1"].procedure_count) == (2, "A,B", 2, 2)
    assert (got["2"].diagnosis_count, got["2"].diagnosis_codes) == (0, None)
    assert got["3"].median_los_by_type == 26.5 and got["4"].median_los_by_type == -24.0
    assert got["1"].avg_diagnosis_by_dept == 1.0 and got["3"].avg_diagnosis_by_dept == 0.0
    assert [got[k].discharge_category for k in "1234"] == ["SHORT_STAY", "HOME_DISCHARGE", "POST_ACUTE", "MORTALITY"]


def test_median_of_a_hot_key(spark):
    df = spark.range(1001).select(F.lit("k").alias("k"), F.when(F.col("id") < 900, 7).otherwise(F.col("id")).cast("int").alias("v"))
    assert median_by(df, "k", "v", "m").head().m == 7.0


def test_patient_without_anything(spark):
    patients = spark.createDataFrame([("z", "A", None, None)], "patient_id string, first_name string, last_name string, date_of_birth date")
    diag = spark.createDataFrame([], "encounter_id string, diagnosis_code string, diagnosis_type string")
    bills = spark.createDataFrame([], "patient_id string, amount decimal(38,2), payment_status string")
    row = patient_360(patients, encounters(spark), diag, bills, "2024-01-31 00:00:00").head()
    assert (row.full_name, row.age_group, row.total_encounters, row.total_billed, row.patient_status) == (None, "GERIATRIC", 0, None, "LAPSED")
    assert row.total_paid == 0 and row.diagnoses is None


def test_readmission(spark):
    enc = encounters(
        spark, ("1", "a", "x", "in", at(1), at(2), "home"), ("2", "a", "x", "in", at(1, month=2), at(2, month=2), "home"),
        ("3", "a", "x", "in", at(4, month=3), None, "home"), ("4", None, "x", "in", at(1), at(2), "home"), ("5", None, "x", "in", at(2), at(3), "home"),
    )
    diag = spark.createDataFrame([("1", "B"), ("1", "A")], "encounter_id string, diagnosis_code string")
    proc = spark.createDataFrame([], "encounter_id string, procedure_code string")
    facts = fact_encounters(enc, diag, proc, "2024-04-01 00:00:00", "b")
    got = {r.encounter_id: r for r in facts.collect()}
    # 2 January + 30 days is 1 February; 2 February + 30 days is 3 March.
    assert (got["1"].readmission_within_30d, got["2"].readmission_within_30d, got["4"].readmission_within_30d) == (True, False, False)
    assert (got["1"].primary_diagnosis_code, got["3"].length_of_stay_hours, got["1"].admit_time) == ("A", None, "00:00:00")
    (row,) = readmission_rates(facts.filter("patient_id is not null"), "2024-01-01", "2024-01-31").collect()
    # The readmission's own discharge is outside the range, so it is not seen.
    assert (row.total_discharges, row.readmissions, str(row.readmission_rate)) == (1, 0, "0.00")
    assert len({r.encounter_sk for r in got.values()}) == 5


def test_quality(spark):
    schema = "event_id string, event_date date, event_time timestamp_ntz"
    empty = spark.createDataFrame([], schema)
    got = {r.check_name: (r.check_value, r.check_status) for r in quality_checks(empty, "2024-01-31 00:00:00").collect()}
    assert got == {"row_count": ("0", "FAIL"), "duplicate_check": ("0", "PASS"), "null_check": ("0", "PASS"), "freshness_check": (None, "FAIL")}
    day = dt.date(2024, 1, 31)
    some = spark.createDataFrame([("1", day, at(30)), ("1", day, at(29)), (None, day, None)], schema)
    got = {r.check_name: (r.check_value, r.check_status) for r in quality_checks(some, "2024-01-31 00:00:00").collect()}
    assert got == {"row_count": ("3", "PASS"), "duplicate_check": ("1", "FAIL"), "null_check": ("1", "FAIL"), "freshness_check": ("2024-01-30 00:00:00", "PASS")}


def test_latency_alert(spark):
    loads = spark.createDataFrame([("f", at(31, h)) for h in range(0, 24) if h != 5], "facility_id string, _loaded_at timestamp_ntz")
    facilities = spark.createDataFrame([("f",), ("g",)], "facility_id string")
    got = latency_alert(loads, facilities, "2024-01-31 09:30:00", lookback_hours=8)
    assert rows(got.filter("facility_id = 'f'"), "hour_bucket") == [(at(31, 5),)]
    assert got.filter("facility_id = 'g'").count() == 7


def test_radius_edge_and_cells(spark):
    branches = spark.createDataFrame([("b", 0, 0)], "branch string, x int, y int")
    points = spark.createDataFrame([("on", 0, 1000), ("out", 1, 1000), ("neg", -600, -800), ("in", 3, 4)], "poi string, x int, y int")
    assert rows(join_radius(branches, points, 1000.0), "poi", "distance") == [("in", 5.0), ("neg", 1000.0), ("on", 1000.0)]


def test_market(spark):
    branches = spark.createDataFrame([("near", 0, 0, 1000), ("far", 99999, 0, 1000)], "branch string, x int, y int, base_pop int")
    pois = spark.createDataFrame([("Barber", 10, 0), ("CLINIC", 0, 300), ("Clinic", 301, 0), ("Spa bar", 5, 5)], "name string, x int, y int")
    got = {r.branch: r for r in market_dna(branches, pois).collect()}
    near, far = got["near"], got["far"]
    assert (near.est_pop, near.lifestyle_drivers, near.social_drivers, near.competition, near.high_pressure_comp) == (1333, 2, 2, 2, 1)
    assert (far.est_pop, far.competition) == (0, 0) and far.actionable_strategy.startswith("STABLE") and "CORE" in far.actionable_strategy


def test_sheet(spark):
    df = spark.createDataFrame([("9500", "2024-01-02", "34", "nan"), ("N/A", "soon", "1980-02-03", None), ("nan", None, None, "x")], "Total_Bill string, `ADM DATE` string, Age_or_DOB string, Note string")
    assert rows(clean_sheet(df)) == sorted([(9500.0, "2024-01-02", "34.0", ""), (0.0, "", "1980-02-03", ""), (0.0, "", "", "x")], key=repr)


def test_monthly_report(spark, inputs):
    facts = fact_encounters(inputs("fx_encounters"), inputs("fx_diagnoses"), inputs("fx_procedures"), AS_OF, "batch-1")
    shifted = facts.withColumn("admit_date", F.add_months("admit_date", 12 * 25))
    record = monthly_report(daily_facility_metrics(labelled(inputs), AS_OF), shifted, dim_patient(inputs("fx_patients"), AS_OF), "2024-01-01")
    got = {r.facility_id: (r.month, json.loads(r.report)) for r in record.select("month", "facility_id", F.to_json("report").alias("report")).collect()}
    assert set(got) == {"F0", "F1", "F2", "F3", "F4"}
    metrics = {(r.facility_id, str(r.metric_date)): r for r in daily_facility_metrics(labelled(inputs), "2024-01-31 00:00:00").collect()}
    new = inputs("fx_patients").filter("trunc(created_date, 'month') = '2024-01-01'")
    genders = {r[0]: r[1] for r in new.groupBy("gender").count().collect()}
    for facility, (month, report) in got.items():
        assert month == dt.date(2024, 1, 1) and report["month"] == "2024-01-01"
        days = {d["metric_date"]: d for d in report["facility_metrics"]}
        assert {(facility, day) for day in days} == {k for k in metrics if k[0] == facility}
        for day, d in days.items():
            assert d["total_encounters"] == metrics[facility, day].total_encounters and "total_revenue" not in d
        assert len(report["top_procedures"]) <= 10
        assert report["patient_demographics"]["gender_split"] == genders
        assert sum(g["patient_count"] for g in report["patient_demographics"]["age_groups"]) == new.count()


def test_kpis_read_only_what_they_need(spark, inputs):
    plan = daily_kpis(labelled(inputs))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_bucketed_encounters_move_no_rows(spark, inputs, tmp_path):
    names = ("fx_encounters", "fx_diagnoses", "fx_procedures")
    assert all(largest_share(inputs(n), "encounter_id") < 0.1 for n in names)
    tables = [write_bucketed(inputs(n), f"test_{n}", "encounter_id", 4, str(tmp_path / n)) for n in names]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, bucketed = encounter_metrics(*map(inputs, names)), encounter_metrics(*tables)
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(encounter_id")
        assert exchanges(plain) == 3 and exchanges(bucketed) == 0
        assert rows(bucketed) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in names:
            spark.sql(f"DROP TABLE test_{n}")


def test_flat_events_are_cleaned_once(spark):
    from carelake import registry
    from conftest import SF_DIR

    plan = registry.queries()["ds_clean_events_flat"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan  # the result reads stored rows


def test_stock_windows_sort_once(spark):
    from pyspark.sql import Window

    from carelake.plans.inventory import STOCK_KEYS, STOCK_ORDER, stock_windows
    from carelake.operators.ordered import nulls_last

    cost = "CASE WHEN id % 100 BETWEEN 10 AND 55 OR id % 7 = 0 THEN NULL ELSE CAST(id * 1.37 - 40 AS DECIMAL(38,2)) END"
    daily = spark.range(100).selectExpr(
        "CASE WHEN id < 80 THEN 'F1' END AS facility_id", "CASE WHEN id < 90 THEN 'p' END AS product_id", "CASE WHEN id % 11 > 0 THEN DATE '2024-01-01' + CAST(id AS INT) END AS movement_date",
        "CAST(id AS STRING) AS product_name", "'c' AS product_category", f"{cost} AS issue_cost", f"{cost} AS issues", f"{cost} AS net_change",
    )
    frame = Window.partitionBy(*STOCK_KEYS).orderBy(*nulls_last(*STOCK_ORDER)).rowsBetween(-29, 0)
    expected = daily.select("product_name", F.sum("issue_cost").over(frame), F.sum("issues").over(frame))
    found = stock_windows(daily)
    assert rows(found, "product_name", "monthly_usage_cost", "monthly_usage_quantity") == rows(expected)
    assert any(r.monthly_usage_cost is None for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Window [") == 2 and plan.count("Sort [") == 1
