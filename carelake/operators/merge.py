"""MERGE on plain tables: the target joined to a staged delivery, plus the new rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

Key = str | Column


def _key(k: Key) -> Column:
    return F.col(k) if isinstance(k, str) else k


class DuplicateKeys(ValueError):
    """The source of a merge holds several rows for one key."""


def require_unique(df: DataFrame, keys: list[Key]) -> None:
    """Raise when a non-NULL key occurs twice (partial counts first, so no key is hot)."""
    named = [_key(k).alias(f"k{i}") for i, k in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    twice = (
        df.select(*named).dropna(subset=names).groupBy(*names)
        .agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    )
    if twice:
        raise DuplicateKeys(f"duplicate source key: {twice[0].asDict()}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[Key],
    update_cols: list[str],
    insert_cols: list[str] | None = None,
    when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """The target after a merge, in the target's columns.

    * the source is staged (written once), then the target is left-joined to it, and
      source rows whose key the target lacks are added. A small delivery is therefore
      broadcast by its measured size and the large target is not shuffled; with a large
      delivery both joins are sort-merge joins whose hot target keys AQE can split
      (a full outer join allows neither);
    * a NULL key matches nothing: such target rows stay, such source rows are inserted;
    * ``when(t, s)`` guards the update, ``t("col")`` and ``s("col")`` naming the sides;
    * ``on_update`` / ``on_insert`` set columns that are not in the source;
    * source keys must be unique: a job over the staged source verifies it and raises
      ``DuplicateKeys`` (``check_unique=False`` only where they are grouped by just before).
    The source is written when this is called, not when the result is read.
    """
    insert_cols = insert_cols if insert_cols is not None else [c for c in target.columns if c in source.columns]
    on_update, on_insert = on_update or {}, on_insert or {}
    types = {f.name: f.dataType for f in target.schema.fields}
    guards: set[str] = set()

    def s(c: str) -> Column:
        guards.add(c)
        return F.col(f"_s_{c}")

    guard = when(F.col, s) if when else F.lit(True)
    wanted = set(update_cols) | set(insert_cols) | guards
    names = [f"_k{i}" for i in range(len(keys))]
    staged = written(
        source.select(
            *[_key(k).alias(n) for k, n in zip(keys, names)],
            F.lit(True).alias("_s"),
            *[F.col(c).alias(f"_s_{c}") for c in source.columns if c in wanted],
        ),
        "merge-source",
    )
    if check_unique:
        require_unique(staged, names)

    keyed = target.select(*[_key(k).alias(n) for k, n in zip(keys, names)], *target.columns)
    update = F.col("_s").isNotNull() & F.coalesce(guard, F.lit(False))

    def updated(c: str) -> Column:
        if c in on_update:
            new = on_update[c]
        elif c in update_cols:
            new = F.col(f"_s_{c}")
        else:
            return F.col(c)
        return F.when(update, new.cast(types[c])).otherwise(F.col(c)).alias(c)

    def inserted(c: str) -> Column:
        if c in on_insert:
            new = on_insert[c]
        else:
            new = F.col(f"_s_{c}") if f"_s_{c}" in staged.columns and c in insert_cols else F.lit(None)
        return new.cast(types[c]).alias(c)

    kept = keyed.join(staged, names, "left").select(*[updated(c) for c in target.columns])
    # Keys present on both sides: at most the keys of the delivery.
    matched = keyed.select(*names).join(staged.select(*names), names, "left_semi").distinct()
    added = staged.join(matched, names, "left_anti").select(*[inserted(c) for c in target.columns])
    return kept.unionByName(added)
