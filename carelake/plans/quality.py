"""Quality checks, load monitor and latency alert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import as_of_column, hour_start, minute_diff
from ..functions.nulls import count_when
from ..operators.dedup import duplicate_keys


def _check(name: str, value, passed):
    return F.struct(
        F.lit(name).alias("check_name"),
        value.cast("string").alias("check_value"),
        F.when(passed, "PASS").otherwise("FAIL").alias("check_status"),
    )


def _measures(as_of) -> list:
    return [
        F.count_if(F.col("event_date") == as_of_column(as_of).cast("date")).alias("_day"),
        F.count_if(F.col("event_id").isNull()).alias("_missing"),
        F.max("event_time").alias("_newest"),
    ]


def _judged(measured: DataFrame, as_of) -> DataFrame:
    """The three checks that one pass over the rows measures."""
    fresh_from = as_of_column(as_of) - F.make_dt_interval(hours=F.lit(24))
    day, missing, newest = F.col("_day"), F.col("_missing"), F.col("_newest")
    return measured.select(
        F.inline(
            F.array(
                _check("row_count", day, day > 0),
                _check("null_check", missing, missing == 0),
                _check("freshness_check", F.date_format(newest, "yyyy-MM-dd HH:mm:ss"), newest >= fresh_from),
            )
        )
    )


def _duplicates(clean: DataFrame) -> DataFrame:
    return duplicate_keys(clean.select("event_id"), ["event_id"]).agg(F.count("*").alias("_n")).select(
        F.inline(F.array(_check("duplicate_check", F.col("_n"), F.col("_n") == 0)))
    )


def quality_checks(clean: DataFrame, as_of) -> DataFrame:
    """One row per check: rows of the day, duplicate ids, missing ids, freshness (24 h).

    Three checks share one pass; the duplicates need a count per id.
    """
    return _judged(clean.agg(*_measures(as_of)), as_of).unionByName(_duplicates(clean))


def write_checked(clean: DataFrame, path: str, as_of) -> DataFrame:
    """Write CLEAN and give the checks on what was written.

    Three of them are observed by the job that writes; only the duplicate ids are counted
    afterwards, from that one column of the written table.
    """
    spark = clean.sparkSession
    seen = Observation()
    clean.observe(seen, *_measures(as_of)).write.parquet(path)
    found = seen.get
    newest = None if found["_newest"] is None else str(found["_newest"])
    measured = spark.range(1).select(
        F.lit(found["_day"]).cast("bigint").alias("_day"), F.lit(found["_missing"]).cast("bigint").alias("_missing"),
        F.lit(newest).cast(clean.schema["event_time"].dataType).alias("_newest"),
    )
    return _judged(measured, as_of).unionByName(_duplicates(spark.read.schema(clean.schema).parquet(path)))


def load_span(df: DataFrame, keys: list, time_col: str = "_loaded_at") -> DataFrame:
    """First and last load per key and the minutes between."""
    return df.groupBy(*keys).agg(
        F.min(time_col).alias("first_load"),
        F.max(time_col).alias("last_load"),
        minute_diff(F.min(time_col), F.max(time_col)).alias("load_duration_minutes"),
    )


def hourly_load_monitor(loads: DataFrame, as_of, lookback_days: int = 1) -> DataFrame:
    """Loads of the look-back per hour, facility, module and table."""
    since = as_of_column(as_of) - F.make_dt_interval(days=F.lit(lookback_days))
    at = F.col("_loaded_at")
    return loads.filter(at >= since).groupBy(
        hour_start("_loaded_at").alias("hour_bucket"), "facility_id", "module_source", "source_table"
    ).agg(
        F.count("*").alias("record_count"),
        F.countDistinct("row_hash").alias("unique_records"),
        count_when(F.col("validation_status") != "VALID").alias("error_count"),
        F.min(at).alias("first_load"),
        F.max(at).alias("last_load"),
        minute_diff(F.min(at), F.max(at)).alias("load_duration_minutes"),
    )


def latency_alert(loads: DataFrame, facilities: DataFrame, as_of, lookback_hours: int = 24, quiet_hours: int = 2) -> DataFrame:
    """Hours of the look-back, at least ``quiet_hours`` old, in which a facility loaded nothing.

    Every facility gets the full row of hours (a sequence, not a join with a calendar).
    """
    now = as_of_column(as_of).cast("timestamp")
    first = F.date_trunc("hour", now - F.make_dt_interval(hours=F.lit(lookback_hours)))
    last = F.date_trunc("hour", now - F.make_dt_interval(hours=F.lit(quiet_hours)))
    hours = F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))
    spine = (
        facilities.select("facility_id").distinct()
        .withColumn("hour_bucket", F.explode(hours))
        .withColumn("hour_bucket", F.col("hour_bucket").cast("timestamp_ntz"))
    )
    since = first.cast("timestamp_ntz")
    loaded = loads.filter(F.col("_loaded_at") >= since).groupBy(
        "facility_id", hour_start("_loaded_at").alias("hour_bucket")
    ).agg(F.count("*").alias("_n"))
    return (
        spine.join(loaded, ["facility_id", "hour_bucket"], "left")
        .withColumn("record_count", F.coalesce("_n", F.lit(0).cast("bigint")))
        .filter(F.col("record_count") == 0)
        .select("facility_id", "hour_bucket", "record_count")
    )
