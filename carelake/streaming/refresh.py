"""Refreshes: look-back aggregates, materialized datasets, and the high-water mark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.mart import daily_metrics_source, refresh_daily_metrics
from ..session import scratch
from ..sources.tables import Table

WATERMARK_START = "1970-01-01 00:00:00"
WATERMARK_SCHEMA = "facility_id string, updated_since timestamp_ntz"


def refresh_aggregates(clean: DataFrame, metrics: Table, as_of, lookback_hours: int = 24) -> Table:
    """Merge the look-back aggregate of ``clean`` into the daily metrics table."""
    source = daily_metrics_source(clean, as_of, lookback_hours)
    return metrics.replace(refresh_daily_metrics(metrics.read(), source, as_of))


def refresh_on_arrival(events: DataFrame, read_clean: Callable[[], DataFrame], metrics: Table, checkpoint: str, lookback_hours: int = 24, continuous: str | None = None) -> StreamingQuery:
    """Refresh the metrics whenever new events arrive.

    Distinct counts cannot be added up over batches, so each batch recomputes the
    look-back from the CLEAN table up to the batch's newest event; a batch that is
    replayed after a failure gives the same table.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        newest = batch.agg(F.max("event_time")).head()[0]
        if newest is not None:
            with scratch(batch.sparkSession):
                refresh_aggregates(read_clean(), metrics, newest, lookback_hours)

    writer = events.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


class Materialized:
    """Named datasets kept as written tables, rebuilt on request."""

    def __init__(self):
        self._entries: dict[str, tuple[Callable[[], DataFrame], str]] = {}

    def register(self, name: str, build: Callable[[], DataFrame], root: str) -> None:
        self._entries[name] = (build, root)

    def refresh(self, names: list[str] | None = None) -> list[str]:
        done = []
        for name in names or list(self._entries):
            build, root = self._entries[name]
            df = build()
            Table(df.sparkSession, root, df.schema).replace(df)
            done.append(name)
        return done

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        build, root = self._entries[name]
        return Table(spark, root, build().schema).read()


def _watermarks(spark: SparkSession, root: str) -> Table:
    schema = spark.createDataFrame([], WATERMARK_SCHEMA).schema
    return Table(spark, root, schema)


def get_watermark(spark: SparkSession, root: str, facility: str) -> str:
    """The facility's high-water mark; the epoch before its first run."""
    rows = _watermarks(spark, root).read().filter(F.col("facility_id") == facility).collect()
    return str(rows[0]["updated_since"]) if rows else WATERMARK_START


def set_watermark(spark: SparkSession, root: str, facility: str, at) -> None:
    """Advance the mark; called after a run succeeded. One row per facility."""
    row = spark.createDataFrame([(facility, str(at))], "facility_id string, at string").select(
        "facility_id", F.col("at").cast("timestamp_ntz").alias("updated_since")
    )
    _watermarks(spark, root).ensure().merge(row, ["facility_id"], ["updated_since"])


def advance_watermarks(df: DataFrame, root: str, column: str = "ingested_at") -> None:
    """Advance the mark of every facility to its newest loaded row, in one pass; never back."""
    newest = df.filter(F.col("facility_id").isNotNull()).groupBy("facility_id").agg(
        F.max(column).cast("timestamp_ntz").alias("updated_since")
    )
    _watermarks(df.sparkSession, root).ensure().merge(
        newest, ["facility_id"], ["updated_since"],
        when=lambda t, s: t("updated_since") < s("updated_since"),
    )


def read_watermarks(spark: SparkSession, root: str) -> DataFrame:
    return _watermarks(spark, root).read()
