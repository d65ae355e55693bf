"""Tables kept in buckets of a key, so that joins and sums by it move no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """The catalog table ``name``: ``df`` in ``buckets`` by a hash of ``key``, sorted by it, replaced if it is there.

    Rows are brought to their buckets before the write, so a bucket is one file. Tables that are
    joined need the same number of buckets, or one a multiple of the other. A key with a third of
    all rows is one bucket: keep such a table unbucketed, where a join can split it. With ``path``
    the files stand there (a shared folder), else in the warehouse.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def largest_share(df: DataFrame, key: str) -> float:
    """The share of rows that the most frequent value of ``key`` holds, to judge whether buckets fit."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    found = counts.agg((F.max("n") / F.sum("n")).alias("share")).first()
    return found.share or 0.0
