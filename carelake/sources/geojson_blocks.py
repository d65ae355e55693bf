"""Features of GeoJSON files of any size, read by as many tasks as a file has blocks.

A file is read in pieces that end at ``}``. Each block of pieces sums up its quotes and, for both
states it may start in, its braces outside strings; the sums of the blocks before it tell the
state and depth in which it starts. An object from depth one to two and back is a feature, and
is parsed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Up to the first brace that is outside strings, and up to the end of a string that is open.
TO_BRACE = r'^[^"{]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{]*+)*+\{'
TO_QUOTE = r'^[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _count(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("long")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text of files between closing braces, with file, block and order in the block."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("value").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"))


def features(found: DataFrame) -> DataFrame:
    """``file`` and ``feature`` (JSON text) for each object at depth two of the files' documents.

    A file holds one document, an object. Work is by piece; a feature has to fit in memory, a file need not.
    One exchange brings the pieces of a block together, one the pieces of a feature.
    """
    plain = F.regexp_replace("piece", r"\\.", "")  # without escaped signs
    parts = F.split(plain, '"')

    def opened(start: int) -> Column:
        """Braces outside strings, if the piece starts outside (0) or inside (1) one."""
        return F.aggregate(F.filter(parts, lambda _, i: i % 2 == start), F.lit(0).cast("long"), lambda total, x: total + _count(x, "{"))

    measured = found.withColumns({"quotes": _count(plain, '"'), "open0": opened(0), "open1": opened(1)})
    block = Window.partitionBy("file", "block").orderBy("no")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    running = measured.withColumn("within", F.coalesce(F.sum("quotes").over(before), F.lit(0)))

    def net(inside: Column) -> Column:
        """What a piece adds to the depth; its closing brace counts outside strings."""
        closes = F.when((inside.cast("long") + F.col("quotes")) % 2 == 0, 1).otherwise(0)
        return F.when(inside, F.col("open1")).otherwise(F.col("open0")) - closes

    # For a block that starts outside a string, and for one that starts inside.
    outside_first, inside_first = F.col("within") % 2 == 1, F.col("within") % 2 == 0
    totals = running.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.sum(net(outside_first)).alias("net0"), F.sum(net(inside_first)).alias("net1"))
    with_quotes = totals.withColumn("ahead", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
    own = F.when(F.col("ahead") % 2 == 0, F.col("net0")).otherwise(F.col("net1"))
    starts = with_quotes.withColumn("own", own).select(
        F.col("file").alias("of_file"), F.col("block").alias("of_block"), "ahead", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("depth_ahead")
    )
    placed = running.join(starts, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")), "left")
    ahead = F.coalesce("ahead", F.raise_error(F.lit("the blocks of a file changed while it was read")).cast("long"))
    stated = placed.withColumn("inside", (F.col("within") + ahead) % 2 == 1).withColumn("net", net(F.col("inside")))
    deep = stated.withColumn("depth", F.col("depth_ahead") + F.coalesce(F.sum("net").over(before), F.lit(0))).withColumn("after", F.col("depth") + F.col("net"))
    # A feature ends where the depth is one again; the pieces up to there carry its number in the file.
    ends = deep.withColumn("ends", ((F.col("after") <= 1) & (F.col("net") < 0) | (F.col("depth") <= 1) & (F.col("after") == 1)).cast("long"))
    counted = ends.groupBy("file", "block").agg(F.sum("ends").alias("n")).select(
        F.col("file").alias("in_file"), F.col("block").alias("in_block"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_ahead")
    )
    numbered = ends.withColumn("nth", F.coalesce(F.sum("ends").over(before), F.lit(0))).join(counted, (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("in_block")))
    # What stands before a feature's first brace goes: commas, and in a file's first piece the document's own brace.
    head = F.when(F.col("inside"), F.regexp_replace("piece", TO_QUOTE, "")).otherwise(F.col("piece"))
    cut = F.when(F.col("depth") == 0, F.regexp_replace(F.regexp_replace(head, TO_BRACE, ""), TO_BRACE, "{")).when(
        F.col("depth") == 1, F.regexp_replace(head, TO_BRACE, "{")).otherwise(F.col("piece"))
    some = numbered.where((F.col("depth") > 1) | (F.col("depth") + F.when(F.col("inside"), F.col("open1")).otherwise(F.col("open0")) > 1))
    grouped = some.groupBy("file", (F.col("nth") + F.col("n_ahead")).alias("nth")).agg(F.sort_array(F.collect_list(F.struct("block", "no", cut.alias("piece")))).alias("all"))
    return grouped.select("file", F.concat(F.array_join(F.transform("all", lambda x: x["piece"]), "}"), F.lit("}")).alias("feature"))


def feature_files(rows: DataFrame, keys: list[str], feature: Column, per_file: int = 1000) -> DataFrame:
    """``value``: FeatureCollections of one key each and about ``per_file`` features, however many a key has."""
    n = rows.groupBy(*keys).agg(F.count("*").alias("n_features"))
    salted = rows.withColumn("a_feature", feature).join(n, keys).withColumn(
        "part", F.pmod(F.xxhash64("a_feature"), F.ceil(F.col("n_features") / per_file))
    )
    collected = salted.groupBy(*keys, "part").agg(F.collect_list("a_feature").alias("features"))
    return collected.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))
