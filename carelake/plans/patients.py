"""Patients: summary, acuity and journey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.clinical import appointment_outcome, patient_age_group, recency_status
from ..functions.dates import as_of_column, day, day_diff, month_start, year_diff
from ..functions.nulls import count_when, mean, safe_div, sum_when
from ..operators.ordered import HOT_ROWS, Blocks, Placed, by_key, nulls_last
from ..session import written

MONEY = "decimal(38,2)"


def visits_by_patient(encounters: DataFrame) -> DataFrame:
    kind = F.col("encounter_type")
    return encounters.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.countDistinct("encounter_id").alias("total_encounters"),
        count_when(kind == "emergency").alias("emergency_visits"),
        count_when(kind == "inpatient").alias("admissions"),
        mean(day_diff("admit_ts", "discharge_ts")).alias("avg_los"),
        F.max(day("admit_ts")).alias("last_visit_date"),
    )


def billing_by_patient(clean: DataFrame, status: str = "payment_status") -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    paid = F.col(status)
    return clean.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.sum("amount").cast(MONEY).alias("total_billed"),
        *[
            sum_when(paid == s, F.col("amount"), zero).cast(MONEY).alias(f"total_{s}")
            for s in ("paid", "pending", "denied")
        ],
    )


def codes_by_patient(encounters: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Distinct diagnosis facts per patient: copies under an encounter go before the join."""
    facts = diagnoses.filter(F.col("encounter_id").isNotNull()).select(
        "encounter_id", "diagnosis_code", "diagnosis_type"
    ).distinct()
    owners = encounters.filter(F.col("patient_id").isNotNull()).select("encounter_id", "patient_id").distinct()
    return facts.join(owners, "encounter_id").groupBy("patient_id").agg(
        F.array_sort(F.collect_set("diagnosis_code")).alias("codes"),
        F.max(F.when(F.col("diagnosis_type") == "chronic", 1).otherwise(0)).alias("has_chronic_condition"),
    )


def patient_360(patients: DataFrame, encounters: DataFrame, diagnoses: DataFrame, clean: DataFrame, as_of) -> DataFrame:
    """One row per patient row; encounters, billing and diagnoses are summed up first."""
    today = as_of_column(as_of)
    zero_count, zero_money = F.lit(0).cast("bigint"), F.lit(0).cast(MONEY)
    codes = codes_by_patient(encounters, diagnoses).select(
        "patient_id", F.nullif(F.array_join("codes", ", "), F.lit("")).alias("diagnoses")
    )
    return (
        patients.withColumns(
            {
                "full_name": F.concat("first_name", F.lit(" "), "last_name"),
                "age": year_diff("date_of_birth", today),
                "age_group": patient_age_group("date_of_birth", today),
            }
        )
        .withColumnRenamed("date_of_birth", "dob")
        .join(visits_by_patient(encounters), "patient_id", "left")
        .join(billing_by_patient(clean), "patient_id", "left")
        .join(codes, "patient_id", "left")
        .withColumns(
            {
                **{c: F.coalesce(c, zero_count) for c in ("total_encounters", "emergency_visits", "admissions")},
                **{c: F.coalesce(c, zero_money) for c in ("total_paid", "total_pending", "total_denied")},
                "days_since_last_visit": day_diff("last_visit_date", today),
                "patient_status": recency_status("last_visit_date", today),
            }
        )
    )


def acuity_score():
    """Weights of the score."""
    return (
        F.col("condition_count") * 0.3
        + F.col("has_chronic_condition") * 0.2
        + F.col("emergency_visits") * 0.2
        + (F.col("avg_los") / 10) * 0.15
        + (F.col("total_charges").cast("double") / 10000) * 0.15
    )


def patient_risk(encounters: DataFrame, diagnoses: DataFrame, clean: DataFrame) -> DataFrame:
    """One row per patient with an encounter."""
    visits = visits_by_patient(encounters).select(
        "patient_id", F.col("total_encounters").alias("encounter_count"), "emergency_visits", "avg_los"
    )
    conditions = codes_by_patient(encounters, diagnoses).select(
        "patient_id", F.size("codes").cast("bigint").alias("condition_count"), "has_chronic_condition"
    )
    charges = clean.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.sum("amount").cast(MONEY).alias("total_charges"), F.max("event_time").alias("last_interaction")
    )
    joined = visits.join(conditions, "patient_id", "left").join(charges, "patient_id", "left")
    return joined.withColumns(
        {
            "condition_count": F.coalesce("condition_count", F.lit(0).cast("bigint")),
            "has_chronic_condition": F.coalesce("has_chronic_condition", F.lit(0)),
        }
    ).withColumn("acuity_score", acuity_score())


def patient_acuity(encounters: DataFrame, diagnoses: DataFrame, clean: DataFrame) -> DataFrame:
    """Risk with its quintile over all patients, highest first; an unknown score ranks first."""
    placed = Placed(
        patient_risk(encounters, diagnoses, clean),
        [F.col("acuity_score").desc_nulls_first(), F.col("patient_id").asc()],
    )
    return placed.rows.withColumn("risk_quintile", placed.ntile(5)).drop("_pos")


TIMELINE = [
    "event_id", "patient_id", "event_time", "event_type", "event_category", "amount", "provider_id", "department_id",
]
TIME_ORDER = ["event_time", "event_id"]


def _neighbours(w: WindowSpec) -> dict[str, Column]:
    """Columns from the rows around an event."""
    three = w.rowsBetween(-2, 0)
    spent = F.sum("amount").over(three).cast("double")
    return {
        "next_event_time": F.lead("event_time").over(w),
        "next_event_type": F.lead("event_type").over(w),
        "prev_event_time": F.lag("event_time").over(w),
        "moving_avg_spend": safe_div(spent, F.count("amount").over(three)),
    }


def _timeline_plain(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("patient_id").orderBy(*nulls_last(*TIME_ORDER))
    month = Window.partitionBy("patient_id", "_month").orderBy(*nulls_last(*TIME_ORDER))
    by_time = Window.partitionBy("patient_id").orderBy(*nulls_last("event_time"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(
        *TIMELINE,
        *[c.alias(n) for n, c in _neighbours(w).items()],
        F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_spend"),
        F.row_number().over(month).cast("bigint").alias("event_number_in_month"),
        F.first("event_time").over(whole).alias("first_interaction"),
        F.last("event_time").over(whole).alias("last_interaction"),
        F.dense_rank().over(by_time).cast("bigint").alias("_step"),
    )


def _timeline_blocked(rows: DataFrame, block_rows: int | None) -> DataFrame:
    blocks = Blocks(
        rows.withColumn("_untimed", F.col("event_time").isNull().cast("int")),
        nulls_last("patient_id", *TIME_ORDER),
        block_rows,
    )
    base, patient = blocks.rows, ["patient_id"]
    # 1 where a patient's clock moves on; its running sum is the rank within the patient.
    moved = {"_moved": lambda w: F.when(F.lag(F.struct("event_time")).over(w).eqNullSafe(F.struct("event_time")), 0).otherwise(1)}
    around = {n: (lambda w, n=n: _neighbours(w)[n]) for n in ("next_event_time", "next_event_type", "prev_event_time", "moving_avg_spend")}
    out = blocks.near(base, patient, around | moved, before=2, after=1)
    out = blocks.running_sums(out, patient, {"cumulative_spend": F.col("amount"), "_step": F.col("_moved")})
    out = blocks.running_sums(out, [*patient, "_month"], {"event_number_in_month": F.lit(1)}, base)
    values = {"first_interaction": (F.min, "event_time"), "_last": (F.max, "event_time"), "_any": (F.max, "_untimed")}
    out = blocks.group_values(out, patient, values, base)
    # An event without a time is the patient's last one.
    return out.withColumn("last_interaction", F.when(F.col("_any") == 0, F.col("_last")))


def patient_timeline(clean: DataFrame, hot_rows: int = HOT_ROWS, block_rows: int | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Each patient's events with neighbours, running values and outcome.

    ``_step`` numbers the distinct times of a patient. ``totals`` may bring the events of
    each patient (patient_id, _n).
    """
    rows = clean.select(*TIMELINE, month_start("event_time").alias("_month"))
    out = by_key(rows, ["patient_id"], _timeline_plain, lambda hot: _timeline_blocked(hot, block_rows), hot_rows, totals=totals)
    return out.withColumns(
        {
            "cumulative_spend": F.col("cumulative_spend").cast(MONEY),
            "days_since_last_event": day_diff("prev_event_time", "event_time"),
            "appointment_outcome": appointment_outcome("event_type", "next_event_type"),
        }
    )


def patient_journey(clean: DataFrame, hot_rows: int = HOT_ROWS, block_rows: int | None = None) -> DataFrame:
    """The timeline with the step number over the whole set.

    DENSE_RANK by (patient, time) is the number of steps of all earlier patients plus
    the rank within the patient. The first part is a prefix sum over one row per
    patient, so events are never sorted as a whole; the join back keeps the
    partitioning of the windows. Events without a patient come last. One aggregate
    per patient gives its steps and its events.
    """
    steps = written(
        clean.groupBy("patient_id").agg(F.countDistinct(F.struct("event_time")).alias("_steps"), F.count("*").alias("_n")), "patient-steps"
    )
    placed = Placed(steps.filter(F.col("patient_id").isNotNull()).drop("_n"), nulls_last("patient_id"), {"_steps": F.col("_steps")})
    offsets = placed.prefix_sums().select("patient_id", "_steps_before")
    rows = patient_timeline(clean, hot_rows, block_rows, steps).join(offsets, "patient_id", "left")
    before = F.coalesce("_steps_before", F.lit(placed.totals["_steps"]))
    return rows.withColumn("journey_step_id", before + F.col("_step")).drop("_steps_before", "_step")


def patient_journey_plain(clean: DataFrame) -> DataFrame:
    """The same with a window over the whole set in one task: a yardstick for tests and bench."""
    rows = _timeline_plain(clean.select(*TIMELINE, month_start("event_time").alias("_month"))).drop("_step")
    steps = Window.orderBy(*nulls_last("patient_id", "event_time"))
    return rows.withColumns(
        {
            "cumulative_spend": F.col("cumulative_spend").cast(MONEY),
            "days_since_last_event": day_diff("prev_event_time", "event_time"),
            "appointment_outcome": appointment_outcome("event_type", "next_event_type"),
            "journey_step_id": F.dense_rank().over(steps).cast("bigint"),
        }
    )
