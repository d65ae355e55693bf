"""The landing zone: gzip JSON lines under Hive-style keys, and the RAW rows read from it."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_of_column
from ..functions.text import safe_token
from ..operators.variant import row_hash
from ..schemas import RAW_EVENTS, conform
from ..session import hadoop_path

KEYS = ["facility_id", "module", "table", "namespace", "dt", "run_id"]
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def write_raw_landing(df: DataFrame, root: str, run_id: str, line: str = "line") -> None:
    """Write the JSON text column ``line`` under facility/module/table/namespace/day/run.

    Key values are sanitised. Writing a run again replaces that run's files only.
    REBALANCE gathers the rows of a folder into few files and lets AQE split a hot
    folder over several tasks.
    """
    namespace = F.translate(F.col("namespace"), "\\", "_")
    named = df.select(
        safe_token("facility_id").alias("facility_id"),
        F.coalesce(F.nullif(safe_token("module"), F.lit("")), F.lit("unknown")).alias("module"),
        F.coalesce(F.nullif(safe_token("table"), F.lit("")), F.lit("unknown")).alias("table"),
        safe_token(namespace).alias("namespace"),
        F.col("dt").cast("date").alias("dt"),
        safe_token(F.lit(run_id)).alias("run_id"),
        F.col(line).alias("value"),
    )
    (
        named.hint("rebalance", *KEYS).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(*KEYS)
        .text(root)
    )


@contextlib.contextmanager
def keys_as_text(spark: SparkSession) -> Iterator[None]:
    """Folder keys stay as they are written: 007 and 1e3 are names, not numbers."""
    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        yield
    finally:
        spark.conf.set(_INFERENCE, before)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    with keys_as_text(spark):
        return spark.read.format("text").load(path)


def _records(value: Column) -> Column:
    """The records of a landed line: the elements of an array, each a VARIANT of its own, or the one value."""
    one = F.array(F.try_parse_json(value))
    return F.when(F.ltrim(value).startswith("["), F.from_json(value, "array<variant>")).otherwise(one)


def _reason(value: Column, records: Column) -> Column:
    """Why a line gave no record: ``too_large`` for JSON beyond what a VARIANT holds, else ``not_json``."""
    json = F.json_array_length(value).isNotNull() | F.json_object_keys(value).isNotNull()
    failed = records.isNull() | (F.size(F.filter(records, lambda r: r.isNull())) > 0)
    return F.when(failed, F.when(json, "too_large").otherwise("not_json"))


def raw_columns(lines: DataFrame, on_error: str = "continue", ingested_at: Column | None = None) -> DataFrame:
    """RAW rows from landed lines, one for each record of a line.

    ``on_error``: continue drops lines that are not JSON and fails on JSON that is too large
    to hold, abort fails on both, quarantine returns only such lines, with the reason.
    """
    if on_error not in ("continue", "abort", "quarantine"):
        raise ValueError(f"unknown on_error {on_error!r}")
    held = set(lines.columns)

    def key(name: str) -> Column:
        meta = {"facility_id": "facility", "module": "module", "table": "table", "namespace": "namespace"}
        stamped = F.try_variant_get("payload", f"$._airflow_meta.{meta[name]}", "string")
        return F.coalesce(stamped, F.col(name).cast("string")) if name in held else stamped

    read = lines.withColumn("_file_name", F.col("_metadata.file_path")).withColumn("_file_time", F.col("_metadata.file_modification_time"))
    read = read.withColumn("_records", _records(F.col("value")))
    read = read.withColumn("_reason", _reason(F.col("value"), F.col("_records")))
    if on_error == "quarantine":
        return read.filter(F.col("_reason").isNotNull()).select("value", "_file_name", F.col("_reason").alias("reason"))
    fatal = F.col("_reason").isNotNull() if on_error == "abort" else F.col("_reason") == "too_large"
    failure = F.raise_error(F.concat(F.lit("landed line is "), F.col("_reason"), F.lit(" in "), F.col("_file_name")))
    # Each line yields its records, nothing, or the failure of the query.
    empty = F.array().cast("array<variant>")
    usable = F.when(F.coalesce(fatal, F.lit(False)), failure.cast("array<variant>")).when(F.col("_reason").isNotNull(), empty).otherwise(F.col("_records"))
    with_payload = read.withColumn("payload", F.explode(usable))
    stamped_at = F.try_variant_get("payload", "$._airflow_meta.ingested_at", "string")
    when = ingested_at if ingested_at is not None else F.col("_file_time")
    return with_payload.select(
        key("facility_id").alias("facility_id"),
        F.coalesce(F.try_to_timestamp(stamped_at), when.cast("timestamp")).alias("ingested_at"),
        (F.col("dt") if "dt" in held else F.lit(None)).cast("date").alias("execution_date"),
        key("module").alias("module_source"),
        key("table").alias("source_table"),
        key("namespace").alias("namespace"),
        "payload",
        F.coalesce(
            F.try_variant_get("payload", "$._airflow_meta.row_hash", "string"), row_hash(F.col("payload"))
        ).alias("row_hash"),
        "_file_name",
    )


def read_raw_landing(spark: SparkSession, path: str, on_error: str = "continue", ingested_at: Column | None = None) -> DataFrame:
    """One row per landed record, with the keys of its folder as text and its file name.

    Filters on facility, table or day prune folders before any file is opened.
    """
    return raw_columns(_lines(spark, path), on_error, ingested_at)


def raw_events(rows: DataFrame, loaded_by: str, loaded_at) -> DataFrame:
    """Landed rows as rows of the RAW table, with who loaded them when.

    The row's own id is a hash of file and record, so a repeated load gives the same.
    """
    return conform(
        rows.withColumns(
            {
                "event_id": F.sha2(F.concat_ws("|", "_file_name", "row_hash"), 256),
                "_loaded_by": F.lit(loaded_by),
                "_loaded_at": as_of_column(loaded_at),
            }
        ),
        RAW_EVENTS,
    )


def archived(landing: str, archive: str) -> str:
    """Where the archive of a stream keeps the files of a landing folder: under their whole path."""
    return archive.rstrip("/") + "/" + re.sub(r"^[a-z0-9+.-]+:/*", "", landing).strip("/")


def register_external(spark: SparkSession, path: str, name: str, archive: bool | str = False) -> DataFrame:
    """A temp view over the landing folder, over its ``archive/`` folder, or, with the path of a stream's archive, over both."""
    if isinstance(archive, str):
        parts = [p for p in (path, archived(path, archive)) if _holds_files(spark, p)]
        df = reduce(DataFrame.unionByName, [read_raw_landing(spark, p) for p in parts or [path]])
    else:
        df = read_raw_landing(spark, f"{path.rstrip('/')}/archive" if archive else path)
    df.createOrReplaceTempView(name)
    return df


def _holds_files(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p) and fs.listFiles(p, True).hasNext()
