"""Window calculations over groups of any size, and over the whole set.

A window sends each partition key to one task, so a patient (or the NULL patient)
holding a third of all rows would stop the job; a window without keys sends
everything to one task. Three tools keep the work spread:

* ``split_hot`` counts the rows per key first (one narrow, map-side combined pass) and
  sets apart the rows of keys above a limit. The others take ordinary windows.
* ``Blocks`` does the windows of the hot rows: a range exchange puts them in order,
  gives each a position and cuts blocks of equal size. Frames of a few rows see copies
  of the rows just across the block border; running sums add what earlier blocks of
  the key summed to; whole-key values combine the parts of keys that cross a border.
  Only two rows per block are exchanged for that.
* ``Placed`` gives positions and prefix sums over a whole set (rank, ntile).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import written

# Rows of one key that a task sorts and spills without trouble.
HOT_ROWS = 2_000_000
MIN_BLOCK_ROWS = 10_000
MAX_BLOCK_ROWS = 1_000_000
MAX_BLOCKS = 100_000


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def split_hot(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, counted: DataFrame | None = None, totals: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and the rows of keys with more than ``hot_rows`` rows.

    The second is None, and the first the input itself, when no key is that large.
    ``counted`` may be a cheaper table with at least as many rows per key, such as the
    rows that ``df`` sums up; ``totals`` the counts themselves (the keys and ``_n``), where
    the caller has them. The hot keys are written, so their size is known to the planner.
    """
    if totals is None:
        totals = (df if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = written(
        totals.filter(F.col("_n") > hot_rows)
        .select(*[F.col(k).alias(f"_h_{k}") for k in keys]),
        "hot-keys",
    )
    if hot.isEmpty():
        return df, None
    on = _same(keys, "_h_")
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def by_key(
    df: DataFrame,
    keys: list[str],
    ordinary: Callable[[DataFrame], DataFrame],
    blocked: Callable[[DataFrame], DataFrame],
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """``ordinary`` windows for most keys, ``blocked`` ones for the rows of hot keys."""
    cold, hot = split_hot(df, keys, hot_rows, counted, totals)
    out = ordinary(cold)
    return out if hot is None else out.unionByName(blocked(hot).select(*out.columns))


class Placed:
    """Rows in a global order, written once, with their 0-based position ``_pos``."""

    def __init__(self, df: DataFrame, order: list[Column], sums: dict[str, Column] | None = None):
        # No number of partitions is given: AQE may join neighbouring small ones, which
        # keeps the order.
        placed = written(
            df.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id()),
            "ordered",
        )
        # monotonically_increasing_id is (partition << 33) + row in the partition.
        part = F.shiftright("_mid", 33)
        sums = sums or {}
        totals = [F.sum(c).alias(name) for name, c in sums.items()]
        # One row per range partition reaches the driver.
        found = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), *totals).collect()
        by_part = {r["part"]: r for r in found}
        self._starts: dict[str, str] = {}
        self.totals: dict[str, int] = {}
        for name in ["n", *sums]:
            at, starts = 0, []
            for p in range(max(by_part, default=-1) + 1):
                starts.append(f"{at}L")
                at += int(by_part[p][name] or 0) if p in by_part else 0
            self._starts[name], self.totals[name] = f"array({', '.join(starts) or '0L'})", at
        self.total = self.totals["n"]
        self._sums = sums
        index = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
        self.rows = placed.withColumn("_pos", self._start("n", part) + index).drop("_mid")
        self._numbered = placed.withColumn("_part", part)

    def _start(self, name: str, part: Column) -> Column:
        return F.get(F.expr(self._starts[name]), part.cast("int"))

    def prefix_sums(self) -> DataFrame:
        """The rows with, per summed column, the sum over all earlier rows."""
        before = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        return self._numbered.select(
            "*",
            *[
                (self._start(name, F.col("_part")) + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"{name}_before")
                for name, c in self._sums.items()
            ],
        ).drop("_part", "_mid")

    def ntile(self, n: int) -> Column:
        """NTILE over the whole set, by arithmetic on the position."""
        small, extra = divmod(self.total, n)
        pos, wide = F.col("_pos"), extra * (small + 1)
        return (
            F.when(pos < wide, F.floor(pos / (small + 1)) + 1)
            .otherwise(F.floor((pos - wide) / max(small, 1)) + extra + 1)
            .cast("bigint")
        )


class Blocks(Placed):
    """Rows in a global order, in blocks of equal size."""

    def __init__(self, df: DataFrame, order: list[Column], block_rows: int | None = None):
        super().__init__(df, order)
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        even = min(MAX_BLOCK_ROWS, self.total // (2 * tasks) + 1)
        self.block_rows = block_rows or max(MIN_BLOCK_ROWS, even, self.total // MAX_BLOCKS + 1)
        self.rows = self.rows.withColumn("_block", F.floor(F.col("_pos") / self.block_rows))

    def near(
        self,
        df: DataFrame,
        keys: list[str],
        columns: dict[str, Callable[[WindowSpec], Column]],
        before: int = 1,
        after: int = 0,
    ) -> DataFrame:
        """Add columns whose frame reaches ``before`` rows back and ``after`` ahead."""
        if max(before, after) > self.block_rows:
            raise ValueError("the frame is wider than a block")
        offset = F.col("_pos") - F.col("_block") * self.block_rows
        seen_in = F.array_compact(
            F.array(
                F.col("_block"),
                F.when(offset >= self.block_rows - before, F.col("_block") + 1),
                F.when(offset < after, F.col("_block") - 1),
            )
        )
        w = Window.partitionBy("_block", *keys).orderBy("_pos")
        # One exchange by block serves every window below: blocks are of equal size.
        spread = (
            df.withColumn("_home", F.col("_block"))
            .withColumn("_block", F.explode(seen_in))
            .repartition("_block")
        )
        base = spread.columns
        out = spread.select(*base, *[make(w).alias(name) for name, make in columns.items()])
        return out.filter(F.col("_block") == F.col("_home")).drop("_home")

    def _border_parts(self, df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
        """Aggregates of the (block, key) groups that touch a block border."""
        offset = F.col("_pos") - F.col("_block") * self.block_rows
        at_border = (
            (offset == 0) | (offset == self.block_rows - 1) | (F.col("_pos") == self.total - 1)
        )
        border = (
            df.filter(at_border)
            .select(*[F.col(k).alias(f"_b_{k}") for k in ["_block", *keys]])
            .distinct()
        )
        touching = df.join(border, _same(["_block", *keys], "_b_"), "left_semi")
        return touching.groupBy("_block", *keys).agg(*aggs)

    def _with_border(self, df: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
        names = ["_block", *keys]
        renamed = parts.withColumnsRenamed({k: f"_b_{k}" for k in names})
        joined = df.join(renamed, _same(names, "_b_"), "left")
        return joined.drop(*[f"_b_{k}" for k in names])

    def running_sums(self, df: DataFrame, keys: list[str], sums: dict[str, Column], source: DataFrame | None = None) -> DataFrame:
        """Add running sums from the first row of the key up to the current row.

        Rows of a key must be neighbours in the order. The border sums are read from
        ``source``: the plain ``rows`` where they hold the summed columns, which spares
        a second pass over what ``df`` added.
        """
        parts = self._border_parts(
            df if source is None else source, keys,
            [F.sum(value).alias(f"_p_{name}") for name, value in sums.items()],
        )
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = parts.select(
            "_block", *keys, *[F.sum(f"_p_{n}").over(before).alias(f"_c_{n}") for n in sums]
        )
        here = (
            Window.partitionBy("_block", *keys)
            .orderBy("_pos")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        base = df.columns
        local = df.select(*base, *[F.sum(v).over(here).alias(f"_l_{n}") for n, v in sums.items()])
        joined = self._with_border(local, carried, keys)
        return joined.select(
            *base,
            *[
                F.when(F.col(f"_l_{n}").isNull(), F.col(f"_c_{n}"))
                .otherwise(F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0)))
                .alias(n)
                for n in sums
            ],
        )

    def group_values(self, df: DataFrame, keys: list[str], columns: dict[str, tuple[Callable, str]], source: DataFrame | None = None) -> DataFrame:
        """Add whole-key aggregates; each is (combining function, column): min, max or sum."""
        parts = self._border_parts(
            df if source is None else source, keys,
            [fn(F.col(c)).alias(f"_p_{n}") for n, (fn, c) in columns.items()],
        )
        over_key = Window.partitionBy(*keys)
        whole = parts.select(
            "_block",
            *keys,
            F.lit(True).alias("_crosses"),
            *[fn(F.col(f"_p_{n}")).over(over_key).alias(f"_w_{n}") for n, (fn, _) in columns.items()],
        )
        here = Window.partitionBy("_block", *keys)
        base = df.columns
        local = df.select(
            *base, *[fn(F.col(c)).over(here).alias(f"_l_{n}") for n, (fn, c) in columns.items()]
        )
        joined = self._with_border(local, whole, keys)
        return joined.select(
            *base,
            *[
                F.when(F.col("_crosses"), F.col(f"_w_{n}")).otherwise(F.col(f"_l_{n}")).alias(n)
                for n in columns
            ],
        )


def nulls_last(*names: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in names]
