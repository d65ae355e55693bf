"""Continuous loading and change reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import minute_diff
from ..functions.nulls import count_when
from ..sources.landing import raw_columns

LANDING_SCHEMA = (
    "value string, facility_id string, module string, table string, namespace string, dt date, run_id string"
)


def landing_stream(spark: SparkSession, path: str, on_error: str = "continue", max_files: int = 10_000, archive: str | None = None) -> DataFrame:
    """New landing files as RAW rows; files per trigger are bounded.

    With ``archive`` the files of a batch are moved there once a later batch is planned, under
    their whole path, so the landing folder holds what is new and listing it stays cheap.
    """
    lines = spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", max_files)
    if archive:
        lines = lines.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return raw_columns(lines.format("text").load(path), on_error)


def auto_ingest(spark: SparkSession, landing: str, raw: str, checkpoint: str, continuous: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Append new landing files to the RAW folder, each file once.

    Without ``continuous`` (a processing interval) all files present are loaded and
    the query stops. Two queries over one landing folder need a checkpoint each, and only one
    of them may name an ``archive``.
    """
    writer = (
        landing_stream(spark, landing, archive=archive).writeStream.format("parquet").outputMode("append")
        .option("path", raw).option("checkpointLocation", checkpoint)
        .partitionBy("facility_id", "source_table")
    )
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def append_changes(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 10_000) -> DataFrame:
    """Rows appended to a parquet folder since the reader's checkpoint.

    A reader with an empty checkpoint gets the existing rows first and the
    appended rows after them; to see only new rows, start it before them.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def drain(changes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Consume the changes since the last call into a folder and advance the offset."""
    return (
        changes.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def drain_batches(changes: DataFrame, root: str, checkpoint: str) -> list[str]:
    """The changes since the last call with this checkpoint, a folder for each batch; the new folders.

    A batch that is run again after a failure writes its folder again.
    """
    folders: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{root.rstrip('/')}/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        folders.append(folder)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return folders


def hourly_load_stream(raw: DataFrame, time_col: str = "_loaded_at", late: str = "2 hours") -> DataFrame:
    """Load monitor over a stream: hour buckets close once the watermark passed them.

    Exact distinct counts are not available on streams; the hash count is approximate.
    Rows that are joined with their ``validation_status`` have their errors counted.
    """
    errors = [count_when(F.col("validation_status") != "VALID").alias("error_count")] if "validation_status" in raw.columns else []
    return (
        raw.withWatermark(time_col, late)
        .groupBy(F.window(time_col, "1 hour"), "facility_id", "module_source", "source_table")
        .agg(
            F.count("*").alias("record_count"),
            F.approx_count_distinct("row_hash").alias("unique_records"),
            *errors,
            F.min(time_col).alias("first_load"),
            F.max(time_col).alias("last_load"),
            minute_diff(F.min(time_col), F.max(time_col)).alias("load_duration_minutes"),
        )
        .select(F.col("window.start").alias("hour_bucket"), "*")
        .drop("window")
    )
