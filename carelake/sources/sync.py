"""Dictionary-driven table sync: ensure, stage, then merge by primary key or replace."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dictionary import INGESTED_AT, group_tables, primary_key, schema_from_dictionary
from ..operators.merge import merge_upsert
from .tables import Reader, Table

log = logging.getLogger(__name__)


class TablesFailed(RuntimeError):
    """Some tables of a sync failed; the others are loaded."""

    def __init__(self, failed: dict[str, str]):
        super().__init__(f"tables failed to load: {sorted(failed)}")
        self.failed = failed


def stage(df: DataFrame, rows: list[dict], ingested_at: Column) -> DataFrame:
    """The source rows in the dictionary's columns and types, stamped; unfit values are NULL."""
    schema = schema_from_dictionary(rows)
    by_lower = {c.lower(): c for c in df.columns}
    columns = [
        F.col(by_lower[f.name.lower()]).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
        if f.name != INGESTED_AT
    ]
    return df.select(*columns, ingested_at.cast("timestamp_ntz").alias(INGESTED_AT))


def merge_by_primary_key(target: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Update all columns of matched rows, insert the rest.

    Repeated rows of a delivery are one; rows that differ under one key are an error.
    """
    return merge_upsert(target, staged.distinct(), keys, update_cols=staged.columns)


def load_table(spark: SparkSession, root: str, name: str, rows: list[dict], reader: Reader, ingested_at: Column) -> Table:
    table = Table(spark, f"{root.rstrip('/')}/{name}", schema_from_dictionary(rows)).ensure()
    staged = stage(reader(name), rows, ingested_at)
    keys = primary_key(rows)
    if keys:
        return table.replace(merge_by_primary_key(table.read(), staged, keys))
    return table.replace(staged)


def load_all_tables(spark: SparkSession, dictionary: list[dict], reader: Reader, root: str, ingested_at: Column) -> list[str]:
    """Load every table of the dictionary; one table's failure does not stop the others.

    The loop is over table names; each table's rows stay on the executors.
    """
    failed, done = {}, []
    for name, rows in group_tables(dictionary).items():
        try:
            load_table(spark, root, name, rows, reader, ingested_at)
            done.append(name)
        except Exception as error:  # noqa: BLE001 - reported together at the end
            log.exception("table %s failed", name)
            failed[name] = str(error)
    if failed:
        raise TablesFailed(failed)
    return done
