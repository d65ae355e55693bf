"""Semi-structured payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variant_project(df: DataFrame, spec: dict[str, tuple[str, str]], payload: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """Typed columns from payload paths ('a.b'); what is missing or unfit is NULL."""
    return df.select(
        *(keep or []),
        *[
            F.try_variant_get(F.col(payload), f"$.{path}", dtype).alias(name)
            for name, (path, dtype) in spec.items()
        ],
    )


def source_slice(raw: DataFrame, *tables: str) -> DataFrame:
    """The rows of some source tables; a partition filter on a landed layout."""
    return raw.filter(F.col("source_table").isin(*tables))


def is_array(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))


def is_object(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))


def as_elements(v: Column) -> Column:
    """array<variant>: an array's elements, or the one value itself."""
    return F.when(is_array(v), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))


def flatten_lines(df: DataFrame, payload: str = "payload", value: str = "value") -> DataFrame:
    """One row per record of a landed line, be it an array of records or one record."""
    return df.withColumn(value, F.explode(as_elements(F.col(payload)))).drop(payload)


def flatten_values(df: DataFrame, payload: str = "payload", value: str = "value") -> DataFrame:
    """One row per element of an array payload, one per value of an object payload."""
    others = [c for c in df.columns if c != payload]
    view = df.withColumn("_payload", F.col(payload))
    exploded = view.lateralJoin(
        view.sparkSession.tvf.variant_explode(F.col("_payload").outer())
    )
    return exploded.select(*others, "pos", "key", F.col("value").alias(value))


def api_rows(page: Column) -> Column:
    """The records of an API page: data; success.data if data is absent; .data of an object."""
    data = F.try_variant_get(page, "$.data", "variant")
    absent = data.isNull() | F.is_variant_null(data)
    rows = F.when(absent, F.try_variant_get(page, "$.success.data", "variant")).otherwise(data)
    inner = F.when(is_object(rows), F.try_variant_get(rows, "$.data", "variant")).otherwise(rows)
    return F.when(is_array(inner), F.try_variant_get(inner, "$", "array<variant>"))


def flatten_api_pages(df: DataFrame, page: str = "page", value: str = "payload") -> DataFrame:
    others = [c for c in df.columns if c != page]
    return df.select(*others, F.explode(api_rows(F.col(page))).alias(value))


def row_hash(payload: Column) -> Column:
    """md5 of the key-sorted JSON text; equal records hash equally."""
    return F.md5(F.to_json(payload))


def with_ingest_meta(df: DataFrame, run_id: str, ingested_at: Column, facility: Column, module: Column, table: Column, namespace: Column, payload: str = "payload") -> DataFrame:
    meta = F.struct(
        F.lit(run_id).alias("run_id"),
        ingested_at.alias("ingested_at"),
        facility.alias("facility"),
        module.alias("module"),
        table.alias("table"),
        namespace.alias("namespace"),
        row_hash(F.col(payload)).alias("row_hash"),
    )
    return df.withColumn("_airflow_meta", meta)
