"""Sources mixed to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch, written

#: The hash key has 60 bits; each refinement looks at the next 12.
KEY_BITS, STEP_BITS = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """A row per source: ``source_size`` and ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and split ``share``
    times all sizes; none gets over ``most`` times its own size, and what is above goes to
    the others by weight until none is above. That ends where each source has
    min(cap, level * weight) for one level: with the sources in the order of cap / weight, the
    first whose cap is above its share of what those before have left sets it.
    """
    sources = sizes.groupBy("mix_source").agg(F.sum("mix_size").alias("mix_source_size"))
    # One row per source from here on.
    everything, by_name = Window.partitionBy(), Window.partitionBy().orderBy(F.col("mix_source").asc_nulls_last())
    by_cap = Window.partitionBy().orderBy("mix_ratio", F.col("mix_source").asc_nulls_last())
    ranked = sources.select(
        "*", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("mix_weight"),
        (F.col("mix_source_size") * most).alias("mix_cap"), (F.sum("mix_source_size").over(everything) * F.lit(share)).alias("mix_total"),
    ).withColumn("mix_ratio", F.col("mix_cap") / F.col("mix_weight"))
    level = (F.col("mix_total") - F.sum("mix_cap").over(by_cap) + F.col("mix_cap")) / (
        F.sum("mix_weight").over(everything) - F.sum("mix_weight").over(by_cap) + F.col("mix_weight")
    )
    levelled = ranked.withColumn("mix_level", level).withColumn(
        "mix_level", F.min_by(F.when(F.col("mix_ratio") > F.col("mix_level"), F.col("mix_level")), F.when(F.col("mix_ratio") > F.col("mix_level"), F.col("mix_ratio"))).over(everything)
    )
    return levelled.select(
        "mix_source", "mix_source_size",
        F.least(F.col("mix_cap").cast("double"), F.coalesce(F.col("mix_level") * F.col("mix_weight"), F.col("mix_cap").cast("double"))).alias("mix_target"),
    )


def _thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: how often it is taken whole, and below which key once more.

    Words are summed by source and the key's first bits; the bucket in which the budget runs
    out is known from running sums over a source's buckets, and only its rows go on to the
    next bits. The last bucket is one key: it is taken if that comes nearer to the budget.
    """
    whole = F.when(F.col("mix_source_size") > 0, F.floor(F.col("mix_target") / F.col("mix_source_size"))).otherwise(0)
    budgets = targets.select("*", whole.alias("mix_whole")).withColumn("mix_rest", F.col("mix_target") - F.col("mix_whole") * F.col("mix_source_size"))
    state = budgets.select(F.col("mix_source").alias("at_source"), "mix_rest", F.lit(0).cast("long").alias("mix_below"))
    rows, shift = sizes.select("mix_source", "mix_key", "mix_size"), KEY_BITS
    carried = ["mix_rest", "mix_below"]
    while shift > 0:
        shift -= STEP_BITS
        bucket = F.shiftright("mix_key", shift)
        sums = rows.groupBy("mix_source", bucket.alias("mix_bucket")).agg(F.sum("mix_size").alias("mix_words"))
        sums = sums.join(state, F.col("mix_source").eqNullSafe(F.col("at_source"))).drop("at_source")
        running = F.sum("mix_words").over(Window.partitionBy("mix_source").orderBy("mix_bucket"))
        crossing = (
            sums.withColumn("mix_upto", running + F.col("mix_below"))
            .where("mix_upto > mix_rest and mix_upto - mix_words <= mix_rest")
            .select(F.col("mix_source").alias("at_source"), F.col("mix_bucket").alias("at_bucket"), "mix_rest", (F.col("mix_upto") - F.col("mix_words")).alias("mix_below"), "mix_words")
        )
        state = written(crossing, "mix-boundary")
        if shift:
            near = rows.join(state.select("at_source", "at_bucket"), F.col("mix_source").eqNullSafe(F.col("at_source")) & (bucket == F.col("at_bucket")))
            rows = written(near.select("mix_source", "mix_key", "mix_size"), "mix-rows")
            state = state.select("at_source", *carried)
    last = state.select(
        "at_source",
        (F.col("at_bucket") + F.when(F.col("mix_below") + F.col("mix_words") - F.col("mix_rest") < F.col("mix_rest") - F.col("mix_below"), 1).otherwise(0)).alias("mix_threshold"),
    )
    return budgets.join(last, F.col("mix_source").eqNullSafe(F.col("at_source")), "left").select(
        F.col("mix_source").alias("to_source"), "mix_source_size", "mix_target", "mix_whole", F.coalesce("mix_threshold", F.lit(0)).alias("mix_threshold")
    )


def _keyed(docs: DataFrame) -> list[Column]:
    """Source, size and key of a document; equal rows share all three."""
    key = F.shiftrightunsigned(F.xxhash64(docs["doc_id"], docs["text"]), 64 - KEY_BITS)
    return [docs["source"].alias("mix_source"), n_words(docs["text"]).alias("mix_size"), key.alias("mix_key")]


def _plan(sizes: DataFrame, outer: bool = False) -> DataFrame:
    """The written budgets and thresholds of the sources."""
    plan = _thresholds(sizes, written(source_targets(sizes), "mix-targets"))
    return written(plan, "mix-plan", outer)


def _times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    joined = rows.join(plan, F.col("mix_source").eqNullSafe(F.col("to_source")), "left")
    return joined.withColumn("mix_times", F.col("mix_whole") + F.when(F.col("mix_key") < F.col("mix_threshold"), 1).otherwise(0))


def mix(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, size, source_size, target (its source's) and taken.

    Whole passes over a source come first; the rest of its budget goes to the documents whose
    key is below the source's threshold, so a document is taken at most twice, a larger
    budget keeps all that a smaller one takes, and reruns agree. Documents without words take
    nothing; a null source is a source of its own; rows equal in doc_id and text share a key
    and are taken alike; an empty table gives no rows. Other columns are not read. Jobs run
    while this is called: sizes are written once, then one small table for each 12 key bits.
    """
    sizes = written(docs.select(docs["doc_id"].alias("mix_doc"), *_keyed(docs)), "mix-sizes")
    plan = _plan(sizes)
    return _times(sizes, plan).select(
        F.col("mix_doc").alias("doc_id"), F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_times")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with all their columns; one that is taken twice is there twice.

    A document without words has no size to take and stays as it is, once.
    """
    columns = docs.columns
    keyed = docs.select(F.struct(*[docs[c] for c in columns]).alias("mix_row"), *_keyed(docs))
    with scratch(docs.sparkSession):
        plan = _plan(written(docs.select(*_keyed(docs)), "mix-sizes"), outer=True)
    times = F.when(F.col("mix_size") == 0, 1).otherwise(F.col("mix_times"))
    taken = _times(keyed, plan).withColumn("mix_copies", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return taken.select(*[F.col("mix_row").getField(c).alias(c) for c in columns])
