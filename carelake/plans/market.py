"""What surrounds a branch: demand drivers, competition and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import KEYWORDS, keyword_hit, projected_population, strategy, utm37s
from ..operators.spatial import join_radius

# Radii in metres.
CATCHMENT = 1000.0
PRESSURE = 300.0


def all_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """All attributes of a row as one text."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns or df.columns])


def keyword_counts(df: DataFrame, keys: list, text: Column) -> DataFrame:
    """Rows per key that mention a category's words; categories may overlap."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("poi_count"),
        *[F.sum(F.when(keyword_hit(text, c), 1).otherwise(0)).alias(c) for c in KEYWORDS],
    )


def project(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    x, y = utm37s(lon, lat)
    return points.withColumns({"x": x, "y": y})


def market_dna(branches: DataFrame, pois: DataFrame, text_columns: list[str] | None = None) -> DataFrame:
    """Per branch (branch, x, y, base_pop): population, drivers, competition and strategy.

    Keywords are tested once per point, before the join; the joined pairs are summed
    up where they arise.
    """
    text = all_text(pois, text_columns)
    flags = pois.select("x", "y", *[keyword_hit(text, c).alias(f"_{c}") for c in KEYWORDS])
    near = join_radius(branches.select("branch", "x", "y"), flags, CATCHMENT)
    hit = {c: F.when(F.col(f"_{c}"), 1).otherwise(0) for c in KEYWORDS}
    pressure = F.when(F.col("distance") <= PRESSURE, hit["competition"]).otherwise(0)
    counts = near.groupBy("branch").agg(
        F.count("*").alias("_pois"),
        *[F.sum(hit[c]).alias(c) for c in KEYWORDS],
        F.sum(pressure).alias("high_pressure_comp"),
    )
    numbers = [*KEYWORDS, "high_pressure_comp"]
    return (
        branches.select("branch", "base_pop")
        .join(counts, "branch", "left")
        .withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in numbers})
        .select(
            "branch",
            projected_population("base_pop", "_pois").alias("est_pop"),
            *numbers,
            strategy("high_pressure_comp", "lifestyle_drivers", "social_drivers").alias("actionable_strategy"),
        )
    )
