"""Distinct counts that can be added up: exact bitmaps over dense numbers.

A value gets a number once and keeps it. The members of a key are bits, in rows of 32,768 numbers
each; bitmaps of several days, loads or keys merge by OR, so a count over a week or a month
comes from the stored days, and a new load is merged without looking at the old rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .ordered import Placed


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``value`` and ``number`` (from 0, without gaps) for all values of ``column``; those of ``known`` keep theirs.

    Null is no value. The result is to be stored, and given as ``known`` the next time.
    """
    new = values.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    first = 0
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
        first = known.agg(F.max("number")).first()[0]
        first = 0 if first is None else first + 1
    placed = Placed(new, [F.col("value").asc()]).rows.select("value", (F.col("_pos") + first).alias("number"))
    return placed if known is None else known.select("value", "number").unionByName(placed)


def bitmaps(rows: DataFrame, keys: list[str], column: str, numbers: DataFrame) -> DataFrame:
    """``keys``, ``bucket`` and ``bitmap`` of the values of ``column``; every value must have its number."""
    members = rows.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("value")).distinct()
    missing = F.raise_error(F.lit("a value has no number")).cast("bigint")
    # Bit positions are counted from a number of one on.
    known = members.join(numbers, "value", "left").withColumn("number", F.coalesce("number", missing) + 1)
    return known.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def merged(stored: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Both tables of bitmaps as one; a value that both hold counts once."""
    return stored.unionByName(more).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(stored: DataFrame, keys: list, name: str = "n") -> DataFrame:
    """Exact distinct values per ``keys``, which may be coarser than the stored ones (columns or expressions)."""
    together = stored.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    names = [c for c in together.columns if c not in ("bucket", "bitmap")]
    return together.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


class DistinctStore:
    """Stored numbers and bitmaps of one column; each load is merged into them."""

    def __init__(self, keys: list[str], column: str):
        self.keys, self.column = keys, column
        self.numbers: DataFrame | None = None
        self.stored: DataFrame | None = None

    def load(self, rows: DataFrame) -> DataFrame:
        """Merge the rows' members; loading the same rows again changes nothing."""
        # Both tables are written before they replace the old ones.
        self.numbers = written(numbered(rows, self.column, self.numbers), "numbers")
        more = bitmaps(rows, self.keys, self.column, self.numbers)
        self.stored = written(more if self.stored is None else merged(self.stored, more, self.keys), "bitmaps")
        return self.stored
