"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """Keep the first row of each key in ``order`` (end it in a unique column).

    ``row_number() = 1`` plans as WindowGroupLimit: every map task keeps one row
    per key before the shuffle, so a key holding a third of all rows sends one
    row per task instead of meeting in a single task.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: list, newest: str, tiebreak: list[str]) -> DataFrame:
    order = [F.col(newest).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    return first_per_key(df, keys, order)


def has_id(df: DataFrame, mode: str = "either", id_col: str = "id", uuid_col: str = "uuid") -> DataFrame:
    """Rows that carry an identity: id or uuid present, or a non-blank id."""
    if mode == "either":
        return df.filter(F.col(id_col).isNotNull() | F.col(uuid_col).isNotNull())
    if mode == "non_blank":
        return df.filter(F.nullif(F.trim(F.col(id_col)), F.lit("")).isNotNull())
    raise ValueError(f"unknown mode {mode!r}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
