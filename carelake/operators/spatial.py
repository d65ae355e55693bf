"""Points within a distance of other points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / size)


def join_radius(branches: DataFrame, points: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs of a branch and a point at most ``radius`` apart, with the distance.

    Both sides get the grid cell of size ``radius``; a branch is repeated for its
    own and the eight neighbouring cells, so the join is an equi-join and the exact
    distance is the filter. No hint: Spark broadcasts the branches when their size
    allows it, else the sort-merge join splits hot cells (AQE skew join).
    """
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    near = (
        branches.withColumnsRenamed({x: "_bx", y: "_by"})
        .withColumn("_cx", F.explode(F.transform(steps, lambda d: _cell(F.col("_bx"), radius) + d)))
        .withColumn("_cy", F.explode(F.transform(steps, lambda d: _cell(F.col("_by"), radius) + d)))
    )
    cells = points.withColumn("_cx", _cell(F.col(x), radius)).withColumn("_cy", _cell(F.col(y), radius))
    dx, dy = F.col(x) - F.col("_bx"), F.col(y) - F.col("_by")
    return (
        near.join(cells, ["_cx", "_cy"])
        .withColumn("distance", F.sqrt((dx * dx + dy * dy).cast("double")))
        .filter(F.col("distance") <= radius)
        .drop("_cx", "_cy", "_bx", "_by")
    )
