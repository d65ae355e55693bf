"""CSV files read by as many tasks as they have blocks, with line breaks inside quoted cells.

The lines of a file are read by blocks. Each block counts its quotes; the sums of the blocks
before it tell whether a block starts inside a quoted cell, and with that every line knows
whether it does. Lines that are whole records go on as they are; only the others meet, those of
one record at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"
#: Bytes asked for at a time when only a file's first record is wanted.
HEAD_BYTES = 16_384


def _quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).cast("long")


def csv_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Lines with their file, block (by where it starts) and order in the block."""
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"),
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """``file``, ``record`` and ``first`` (whether it is the file's first record) for the lines of CSV files.

    Quotes stand around cells, and doubled inside them. A cell that is never closed makes one
    record of all that follows it in its file. Blank lines between records are left out; a byte-order mark
    at the start of a file is removed. One exchange brings the lines of a block together; a block
    is as large as a scan's split.
    """
    marked = lines.withColumn("quotes", _quotes(F.col("line")))
    block = Window.partitionBy("file", "block").orderBy("no")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = marked.groupBy("file", "block").agg(F.sum("quotes").alias("total"))
    starts = totals.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead"))
    here = marked.withColumns({"within": F.coalesce(F.sum("quotes").over(before), F.lit(0)), "nth": F.row_number().over(block)})
    placed = here.join(starts, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")), "left")
    # Both readings of the files are split alike; if not, that must not lose a line.
    ahead = F.coalesce("ahead", F.raise_error(F.lit("the blocks of a file changed while it was read")).cast("long"))
    inside = (F.col("within") + ahead) % 2 == 1
    at_start = (F.col("block") == 0) & (F.col("nth") == 1)
    known = placed.select(
        "file", "block", "no", F.when(at_start, F.ltrim(F.col("line"), F.lit(BOM))).otherwise(F.col("line")).alias("line"),
        inside.alias("inside"), ((F.col("within") + F.col("quotes") + F.col("ahead")) % 2 == 1).alias("open"),
    )
    whole = known.where(~F.col("inside") & ~F.col("open") & (F.trim(F.col("line"), F.lit(" \r")) != "")).select("file", "block", "no", F.col("line").alias("record"))
    # Of the few other lines, one that is not inside a cell starts a record.
    parts = known.where(F.col("inside") | F.col("open")).withColumn("starts", (~F.col("inside")).cast("long"))
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    openers = parts.groupBy("file", "block").agg(F.sum("starts").alias("total")).select(
        F.col("file").alias("of_file"), F.col("block").alias("of_block"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead")
    )
    numbered = parts.withColumn("nth", F.sum("starts").over(upto)).join(openers, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")))
    pieces = numbered.groupBy("file", (F.col("nth") + F.col("ahead")).alias("nth")).agg(F.sort_array(F.collect_list(F.struct("block", "no", "line"))).alias("lines"))
    broken = pieces.select("file", F.col("lines")[0]["block"].alias("block"), F.col("lines")[0]["no"].alias("no"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    records = whole.unionByName(broken)
    first = records.where("block = 0").groupBy("file").agg(F.min("no").alias("first_no")).withColumnRenamed("file", "of_file")
    joined = records.join(first, (F.col("file") == F.col("of_file")) & (F.col("block") == 0) & (F.col("no") == F.col("first_no")), "left")
    # A line ends in a line feed, or in a carriage return before it.
    return joined.select("file", F.regexp_replace("record", "\r$", "").alias("record"), F.col("of_file").isNotNull().alias("first"))


def cells(record: Column, n: int) -> Column:
    """The first ``n`` cells of a record as texts, null for empty ones and where there are fewer."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)])
    parsed = F.from_csv(record, schema.simpleString()[len("struct<") : -1].replace(":", " "), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "maxColumns": str(max(n, 20_480))})
    return F.transform(F.array(parsed), lambda row: F.array(*[row[f"c{i}"] for i in range(n)]))[0]


def csv_headers(files: DataFrame) -> DataFrame:
    """``file`` and ``header``, the first record of each file of ``files`` (``path``), opened and read no further.

    An empty file has no row. The files must be in a store that an executor's Python can open
    (local, or by ``pyarrow``); where only Spark's readers reach them, take the first records
    of ``csv_records``.
    """

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(path, first_record(path)) for path in batch["path"]]
            yield pd.DataFrame([(p, h) for p, h in found if h], columns=["file", "header"], dtype=object)

    return files.select("path").mapInPandas(heads, "file string, header string")


def first_record(path: str) -> str | None:
    """The first record that is not blank: its quotes are even at a line's end."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs

    url = urlparse(path)
    if url.scheme in ("", "file"):
        store, name = fs.LocalFileSystem(), unquote(url.path) if url.scheme else path
    else:
        store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as f:
        held, lines = b"", []
        while True:
            at = held.find(b"\n")
            if at < 0 and (more := f.read(HEAD_BYTES)):
                held += more
                continue
            line, held = (held, b"") if at < 0 else (held[:at], held[at + 1 :])
            if lines or line.strip(b"\r\xef\xbb\xbf "):
                lines.append(line)
            if lines and sum(x.count(b'"') for x in lines) % 2 == 0 or at < 0:
                break
    text = b"\n".join(lines).removesuffix(b"\r").decode("utf-8", "replace").removeprefix(BOM)
    return text if text.strip() else None
