"""Scans over the test tables."""

from pyspark.sql import functions as F

from ..fixtures import AS_OF
from ..operators.variant import flatten_api_pages
from ..sources.files import incremental_filter, read_parquet_snapshots
from . import query


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(value AS FLOAT)::DOUBLE AS value, event_type FROM events")
def src_parquet_typed(t):
    casts = {"event_id": "string", "ts": "timestamp_ntz", "value": "float", "event_type": "string"}
    read = read_parquet_snapshots(t.spark, f"{t.sf_dir}/event*.parquet", casts)
    return read.withColumn("value", F.col("value").cast("double"))


@query(f"SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY")
def src_incremental(t):
    return incremental_filter(t("events"), "ts", AS_OF, "1 day").select("event_id", "ts", "event_type")


@query("""
SELECT event_id AS page_no, CAST(event_id AS VARCHAR) AS id, event_type AS type FROM events WHERE event_id % 5 <> 3
UNION ALL SELECT event_id, 'second', event_type FROM events WHERE event_id % 5 = 0
""")
def src_api_pages(t):
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type")))
    second = F.to_json(F.struct(F.lit("second").alias("id"), F.col("event_type").alias("type")))
    shape = F.col("event_id") % 5
    page = (
        F.when(shape == 0, F.concat(F.lit('{"data":['), record, F.lit(","), second, F.lit("]}")))
        .when(shape == 1, F.concat(F.lit('{"success":{"data":['), record, F.lit("]}}")))
        .when(shape == 2, F.concat(F.lit('{"data":{"data":['), record, F.lit("]}}")))
        .when(shape == 3, F.concat(F.lit('{"data":"none","rows":['), record, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"data":null,"success":{"data":{"data":['), record, F.lit("]}}}")))
    )
    pages = t("events").select(F.col("event_id").alias("page_no"), F.parse_json(page).alias("page"))
    return flatten_api_pages(pages).select(
        "page_no",
        F.try_variant_get("payload", "$.id", "string").alias("id"),
        F.try_variant_get("payload", "$.type", "string").alias("type"),
    )
