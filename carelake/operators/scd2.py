"""Slowly changing dimension, type 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .merge import require_unique

VALIDITY = ["effective_date", "end_date", "is_current"]


def scd2_apply(dim: DataFrame, changes: DataFrame, key: str, tracked: list[str], effective_date) -> DataFrame:
    """Put each changed key's new version into its history at ``effective_date``.

    The version that holds the date ends there and the new one takes the rest of its time: it is
    the current one if that was, and ends where a later version begins if the delivery is
    back-dated. A version that began on the date itself is replaced. Where none holds the
    date (before the first, or in a gap) the new one reaches to the next. So the
    versions of a key never overlap or run backwards.

    ``changes`` holds one row per key with ``key`` and the tracked columns (else
    ``DuplicateKeys`` is raised: two would open two versions). Versions that do not hold the date
    pass untouched; columns the changes lack are carried over from the version that held the
    date and NULL where there is none. Rows without a key never match. The dimension is
    joined to the staged changes, so few changes are broadcast.
    """
    day = effective_date if isinstance(effective_date, Column) else F.lit(effective_date).cast("date")
    types = {f.name: f.dataType for f in dim.schema.fields}
    payload = [c for c in dim.columns if c not in VALIDITY]
    staged = written(
        changes.select(
            F.col(key).alias("_k"),
            F.lit(True).alias("_s"),
            day.alias("_day"),
            *[F.col(c).alias(f"_s_{c}") for c in changes.columns if c in payload],
        ),
        "scd2-changes",
    )
    require_unique(staged, ["_k"])
    start, end, at = F.col("effective_date").cast("date"), F.col("end_date").cast("date"), F.col("_day")
    known = dim.withColumn("_k", F.col(key)).join(staged, "_k", "left")
    holds = F.coalesce(F.col("_s") & (start.isNull() | (start <= at)) & (end.isNull() | (at < end)), F.lit(False))
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in tracked])
    changed = holds & differs

    def opened(c: str, carried: Column, until: Column, current: Column) -> Column:
        value = {"effective_date": at, "end_date": until, "is_current": current}.get(c, F.col(f"_s_{c}") if f"_s_{c}" in staged.columns else carried)
        return value.cast(types[c]).alias(c)

    def closed(c: str) -> Column:
        if c == "end_date":
            return F.when(changed, at).otherwise(F.col(c)).cast(types[c]).alias(c)
        if c == "is_current":
            return (F.col(c) & ~changed).alias(c)
        return F.col(c)

    replaced = changed & start.eqNullSafe(at)
    versions = F.array_compact(
        F.array(
            F.when(~replaced, F.struct(*[closed(c) for c in dim.columns])),
            F.when(changed, F.struct(*[opened(c, F.col(c), F.col("end_date"), F.col("is_current")) for c in dim.columns])),
        )
    )
    kept = known.select(F.inline(versions))
    # Keys whose date no version holds, and where the next version begins.
    places = known.where(F.col("_s")).groupBy("_k").agg(F.max(holds).alias("_held"), F.min(F.when(start > at, start)).alias("_next"))
    alone = staged.join(places, "_k", "left").where(~F.coalesce("_held", F.lit(False)))
    new = alone.select(*[opened(c, F.lit(None), F.col("_next"), F.col("_next").isNull()) for c in dim.columns])
    return kept.select(*dim.columns).unionByName(new)
