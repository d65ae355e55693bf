"""Encounters with their diagnoses and procedures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import discharge_category
from ..functions.dates import hour_diff
from ..functions.nulls import mean
from ..session import written


def code_summary(rows: DataFrame, code: str, prefix: str, flag: str | None = None) -> DataFrame:
    """Per encounter: the number of distinct codes, the sorted list, optionally flagged rows.

    Sets of codes are combined before the shuffle, so many copies under one
    encounter stay small.
    """
    codes = F.array_sort(F.collect_set(code))
    extra = [F.sum(F.when(F.col(flag), 1).otherwise(0)).alias("_flagged")] if flag else []
    per = rows.groupBy("encounter_id").agg(codes.alias("_codes"), *extra)
    return per.select(
        "encounter_id",
        F.size("_codes").cast("bigint").alias(f"{prefix}_count"),
        F.nullif(F.array_join("_codes", ","), F.lit("")).alias(f"{prefix}_codes"),
        *([F.col("_flagged").alias("poa_diagnosis_count")] if flag else []),
    )


def encounter_metrics(encounters: DataFrame, diagnoses: DataFrame, procedures: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Encounters with counts and code lists; each side is summed up before its join.

    ``codes`` may bring the diagnoses already summed up.
    """
    d = codes if codes is not None else code_summary(diagnoses, "diagnosis_code", "diagnosis", "present_on_admission")
    p = code_summary(procedures, "procedure_code", "procedure")
    zero = F.lit(0).cast("bigint")
    return (
        encounters.select(
            "encounter_id", "patient_id", "provider_id", "department_id", "encounter_type",
            F.col("admit_ts").alias("admit_date"), F.col("discharge_ts").alias("discharge_date"),
            hour_diff("admit_ts", "discharge_ts").alias("length_of_stay_hours"), "discharge_disposition",
        )
        .join(d, "encounter_id", "left")
        .join(p, "encounter_id", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("diagnosis_count", "procedure_count", "poa_diagnosis_count")})
    )


def median_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Exact median per key from counts per distinct value, so no group meets whole."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.percentile(F.col(value), F.lit(0.5), F.col("_n")).alias(name))


def attach(df: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Add per-key values; a NULL key has values too.

    The values are written first, so their real size is known to the planner: below the
    broadcast threshold ``df`` is not shuffled at all, above it the join is a sort-merge
    join whose hot keys AQE splits.
    """
    other = written(per_key.withColumnRenamed(key, "_key"), "per-key")
    return df.join(other, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def clinical_metrics(encounters: DataFrame, diagnoses: DataFrame, procedures: DataFrame) -> DataFrame:
    """Encounters with counts, codes, the median stay of their type and their department's mean diagnoses.

    The medians need the stays only, and the means a count per encounter, which is written:
    the wide rows are made once, for the result.
    """
    stays = encounters.select("encounter_type", hour_diff("admit_ts", "discharge_ts").alias("length_of_stay_hours"))
    median = median_by(stays, "encounter_type", "length_of_stay_hours", "median_los_by_type")
    codes = written(code_summary(diagnoses, "diagnosis_code", "diagnosis", "present_on_admission"), "diagnosis-codes")
    counts = encounters.select("encounter_id", "department_id").join(codes.select("encounter_id", "diagnosis_count"), "encounter_id", "left")
    department = counts.na.fill(0, ["diagnosis_count"]).groupBy("department_id").agg(mean("diagnosis_count").alias("avg_diagnosis_by_dept"))
    metrics = encounter_metrics(encounters, diagnoses, procedures, codes)
    out = attach(attach(metrics, median, "encounter_type"), department, "department_id")
    return out.withColumn(
        "discharge_category", discharge_category("discharge_disposition", "length_of_stay_hours")
    )
