"""Facts, dimensions, daily metrics, readmissions and the monthly report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clinical import report_age_band
from ..functions.dates import add_days, as_of_column, day, hour_diff, month_start, year_diff
from ..functions.nulls import exact_mean
from ..operators.merge import merge_upsert
from ..operators.ordered import HOT_ROWS, Blocks, by_key, nulls_last
from ..operators.scd2 import scd2_apply
from ..schemas import DAILY_METRICS, DIM_PATIENT, DIM_PROVIDER_SCD2, FACT_ENCOUNTERS, conform

READMISSION_DAYS = 30


def surrogate_key(*parts) -> Column:
    """A key that is the same on every run: sha-256 of the natural key."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def next_in_group(df: DataFrame, key: str, order: list[str], columns: dict[str, str], hot_rows: int = HOT_ROWS, block_rows: int | None = None) -> DataFrame:
    """The following row's values within a key, over groups of any size."""
    base = df.columns

    def ordinary(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(*nulls_last(*order))
        return rows.select(*base, *[F.lead(c).over(w).alias(n) for n, c in columns.items()])

    def blocked(rows: DataFrame) -> DataFrame:
        blocks = Blocks(rows, nulls_last(key, *order), block_rows)
        leads = {n: (lambda w, c=c: F.lead(c).over(w)) for n, c in columns.items()}
        return blocks.near(blocks.rows, [key], leads, before=0, after=1)

    return by_key(df, [key], ordinary, blocked, hot_rows)


def within_days(next_admit, discharge, days: int = READMISSION_DAYS) -> Column:
    return F.coalesce(day(next_admit) <= add_days(discharge, days), F.lit(False))


def fact_encounters(encounters: DataFrame, diagnoses: DataFrame, procedures: DataFrame, as_of, batch_id: str) -> DataFrame:
    """One row per encounter; the primary code is the first in code order.

    What the payer paid counts as payment, what it denied as adjustment.
    """
    now = as_of_column(as_of)
    money = "decimal(38,2)"
    zero = F.lit(0).cast(money)
    primary_d = diagnoses.groupBy("encounter_id").agg(F.min("diagnosis_code").alias("primary_diagnosis_code"))
    primary_p = procedures.groupBy("encounter_id").agg(F.min("procedure_code").alias("primary_procedure_code"))
    status, charges = F.col("payment_status"), F.col("total_charges")
    rows = next_in_group(encounters, "patient_id", ["admit_ts", "encounter_id"], {"_next_admit": "admit_ts"})
    built = (
        rows.join(primary_d, "encounter_id", "left")
        .join(primary_p, "encounter_id", "left")
        .withColumns(
            {
                "encounter_sk": surrogate_key("facility_id", "encounter_id"),
                "admit_date": day("admit_ts"),
                "admit_time": F.date_format("admit_ts", "HH:mm:ss"),
                "discharge_date": day("discharge_ts"),
                "discharge_time": F.date_format("discharge_ts", "HH:mm:ss"),
                "length_of_stay_hours": hour_diff("admit_ts", "discharge_ts"),
                "total_payments": F.when(status == "paid", charges).otherwise(zero),
                "total_adjustments": F.when(status == "denied", charges).otherwise(zero),
                "readmission_within_30d": F.col("patient_id").isNotNull() & within_days("_next_admit", "discharge_ts"),
                "created_at": now,
                "_etl_batch_id": F.lit(batch_id),
            }
        )
        .withColumn("net_revenue", F.col("total_charges") - F.col("total_adjustments"))
    )
    return conform(built, FACT_ENCOUNTERS)


PATIENT_TRACKED = ["first_name", "last_name", "date_of_birth", "gender"]


def dim_patient(patients: DataFrame, as_of) -> DataFrame:
    """Current patient rows; the hash covers the tracked attributes."""
    now = as_of_column(as_of)
    tracked = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PATIENT_TRACKED]
    return conform(
        patients.withColumns(
            {
                "patient_sk": surrogate_key("patient_id"),
                "full_name": F.concat("first_name", F.lit(" "), "last_name"),
                "age": year_diff("date_of_birth", now),
                "is_active": F.lit(True),
                "patient_hash": surrogate_key(*tracked),
                "_valid_from": now,
                "_is_current": F.lit(True),
            }
        ),
        DIM_PATIENT,
    )


def provider_history(history: DataFrame | None, providers: DataFrame, effective_date) -> DataFrame:
    """The provider dimension after a delivery (one row a provider): changed providers get a new version.

    Without ``history`` the delivery begins it. A version's key is a hash of provider and day.
    """
    if history is None:
        history = conform(providers.limit(0), DIM_PROVIDER_SCD2)
    tracked = [c for c in providers.columns if c != "provider_id"]
    applied = scd2_apply(history, providers, "provider_id", tracked, effective_date)
    key = F.md5(F.concat_ws("|", "provider_id", F.col("effective_date").cast("string")))
    return conform(applied.withColumn("provider_sk", key), DIM_PROVIDER_SCD2)


def daily_metrics_source(clean: DataFrame, as_of, lookback_hours: int | None = 24) -> DataFrame:
    """Distinct events, distinct patients and mean amount per day and facility.

    The look-back reaches back to the start of the day it touches: a day is only ever
    replaced by the whole of it.
    """
    events = clean
    if lookback_hours is not None:
        since = F.date_trunc("day", as_of_column(as_of) - F.make_dt_interval(hours=F.lit(lookback_hours))).cast("timestamp_ntz")
        events = clean.filter(F.col("event_time") >= since)
    # A table key is never NULL.
    return events.filter(F.col("event_time").isNotNull() & F.col("facility_id").isNotNull()).groupBy(
        day("event_time").alias("metric_date"), "facility_id"
    ).agg(
        F.countDistinct("event_id").alias("total_encounters"),
        F.countDistinct("patient_id").alias("unique_patients"),
        exact_mean("amount").alias("avg_revenue_per_encounter"),
    )


DAILY_KEYS = ["metric_date", "facility_id"]
DAILY_FILLED = ["total_encounters", "unique_patients", "avg_revenue_per_encounter"]


def refresh_daily_metrics(metrics: DataFrame, source: DataFrame, as_of) -> DataFrame:
    """The metrics table after merging a look-back aggregate."""
    now = as_of_column(as_of)
    return merge_upsert(
        metrics, source, DAILY_KEYS, DAILY_FILLED,
        insert_cols=DAILY_KEYS + DAILY_FILLED,
        on_update={"updated_at": now},
        on_insert={"created_at": now},
    )


def daily_facility_metrics(clean: DataFrame, as_of) -> DataFrame:
    """The whole daily table from CLEAN: the filled columns, all others NULL."""
    source = daily_metrics_source(clean, as_of, None)
    return conform(source.withColumn("created_at", as_of_column(as_of)), DAILY_METRICS)


def readmission_rates(facts: DataFrame, start, end, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per facility: discharges in the range, readmissions within 30 days, rate in percent.

    The range filter comes before the look at the next admission, so an admission
    whose own discharge lies outside the range is not seen.
    """
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    discharges = facts.filter(F.col("discharge_date").between(first, last)).select(
        "facility_id", "patient_id", "encounter_id", "admit_date", "discharge_date"
    )
    led = next_in_group(discharges, "patient_id", ["admit_date", "encounter_id"], {"_next": "admit_date"}, hot_rows)
    again = F.when(within_days("_next", "discharge_date"), 1).otherwise(0)
    counts = led.groupBy("facility_id").agg(
        F.count("*").alias("total_discharges"), F.sum(again).alias("readmissions")
    )
    rate = F.col("readmissions").cast("decimal(20,0)") * F.lit(100) / F.col("total_discharges").cast("decimal(20,0)")
    return counts.withColumn("readmission_rate", rate.cast("decimal(5,2)"))


def procedure_counts(facts: DataFrame, month, *by: str) -> DataFrame:
    """Encounters and charges per procedure among a month's admissions."""
    return (
        facts.filter(month_start("admit_date") == F.lit(str(month)).cast("date"))
        .groupBy(*by, "primary_procedure_code")
        .agg(F.count("*").alias("procedure_count"), F.sum("total_charges").cast("decimal(38,2)").alias("total_charges"))
    )


def _most_frequent() -> list[Column]:
    return [F.col("procedure_count").desc(), F.col("primary_procedure_code").asc_nulls_last()]


def top_procedures(facts: DataFrame, month, n: int = 10) -> DataFrame:
    """The ``n`` most frequent procedures of a month; ties by code."""
    return procedure_counts(facts, month).orderBy(*_most_frequent()).limit(n)


def age_groups(patients: DataFrame) -> DataFrame:
    return patients.groupBy(report_age_band("age").alias("age_group")).agg(F.count("*").alias("patient_count"))


def _objects(*columns: str) -> Column:
    """Rows as a JSON array of objects in sorted order, NULL fields left out."""
    rows = F.array_sort(F.collect_list(F.to_json(F.struct(*columns))))
    return F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]"))


def monthly_report(metrics: DataFrame, facts: DataFrame, patients: DataFrame, month) -> DataFrame:
    """One nested record per facility for a month: daily metrics, top procedures, demographics.

    A facility's lists hold at most 31 days and ten procedures; the demographics (four
    bands and the genders, summed up first) are those of all new patients.
    """
    first = F.lit(str(month)).cast("date")
    days = metrics.filter(month_start("metric_date") == first).groupBy("facility_id").agg(
        _objects(*metrics.columns).alias("_days")
    )
    rank = F.row_number().over(Window.partitionBy("facility_id").orderBy(*_most_frequent()))
    columns = ["primary_procedure_code", "procedure_count", "total_charges"]
    procedures = (
        procedure_counts(facts, month, "facility_id").withColumn("_rank", rank).filter(F.col("_rank") <= 10)
        .groupBy("facility_id").agg(_objects(*columns).alias("_procedures"))
    )
    new = patients.filter(month_start("created_date") == first)
    bands = age_groups(new).agg(_objects("age_group", "patient_count").alias("_bands"))
    genders = new.filter(F.col("gender").isNotNull()).groupBy("gender").agg(F.count("*").alias("n")).agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gender", "n"))))).alias("_genders")
    )
    # The month brings the two demographic sides to every facility. Each of them is one row, so
    # the nested-loop joins that a constant key is planned as are bounded.
    people = bands.withColumn("month", first).join(genders.withColumn("month", first), "month")
    empty = F.lit("[]")
    text = F.concat(
        F.lit(f'{{"month":"{month}","facility_metrics":'), F.coalesce("_days", empty),
        F.lit(',"top_procedures":'), F.coalesce("_procedures", empty),
        F.lit(',"patient_demographics":{"age_groups":'), F.col("_bands"),
        F.lit(',"gender_split":'), F.col("_genders"), F.lit("}}"),
    )
    return (
        days.join(procedures, "facility_id", "full_outer")
        .withColumn("month", first)
        .join(people, "month")
        .select("month", "facility_id", F.parse_json(text).alias("report"))
    )
