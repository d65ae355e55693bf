"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch, written


def _mark(edges: DataFrame) -> tuple:
    """Count and sums of hashes: the same for the same set of edges."""
    h = F.xxhash64("u", "v")
    one = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftrightunsigned(h, 24)).alias("high"), F.sum(F.pmod(h, F.lit(1 << 40))).alias("low")).first()
    return one.n, one.high, one.low


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for each node u of ``edges`` but the least of its component, which is v.

    Each step links the larger neighbours of every node to its least neighbour, then the
    smaller ones; nodes with many edges are only ever combined by a minimum and a join, so no
    group is gathered in one place. The steps, a few for components of any shape, are
    written to the shared folder.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        with scratch(edges.sparkSession):
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
            large = written(large, "large-star")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            edges = written(small.select("e.u", "e.v").where("u != v").distinct(), "small-star", outer=True)
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges
