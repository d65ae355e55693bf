"""Tables of an operational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .files import incremental_filter

FETCH_ROWS = 50_000


def jdbc_options(url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None, partitions: int | None = None, fetch_rows: int = FETCH_ROWS, **extra: str) -> dict[str, str]:
    """Reader options: rows per fetch and, with a partition column, the parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}
    if partition_column:
        if bounds is None or not partitions:
            raise ValueError("a partition column needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_table(spark: SparkSession, url: str, table: str, incremental_column: str | None = None, as_of=None, lookback: str = "1 day", **options) -> DataFrame:
    """The whole table, or its rows changed within the look-back.

    The predicate is a plain filter, which Spark sends to the database as a WHERE.
    """
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    if incremental_column is None:
        return df
    if as_of is None:
        raise ValueError("an incremental read needs as_of")
    return incremental_filter(df, incremental_column, as_of, lookback)
