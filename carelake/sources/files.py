"""CSV, parquet, JSON, text, log and GeoJSON files."""

from __future__ import annotations

import errno
import json
import os
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache, reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as stores
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path, written
from . import csv_blocks, geojson_blocks

# Cell texts that mean "no value".
NULL_TOKENS = ["", "NULL", "null", "NaN", "nan"]
# Cell texts that a read without given types takes for missing.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
MISSING_LOG = "[MISSING LOG FILE]"
COLON_STAND_IN = "\uf03a"
#: A task that lists folders passes on those it finds after so many entries, or while so many folders wait. The first one lists alone, so it does so soon.
LISTED_AT_ONCE, LISTED_ALONE = (200_000, 20_000), (10_000, 64)
#: Files that a task reads on average, and bytes that it returns at once.
FILES_A_TASK, BYTES_AT_ONCE = 10_000, 4 << 20


# ---- CSV

def union_csv_folder(spark: SparkSession, path: str, open_files: bool = True) -> DataFrame:
    """All ``*.csv`` of a folder united by column name, full-row duplicates removed.

    Each file has its own header; empty files are skipped. All cells are read as text, missing
    words as NULL; one pass over the united rows then finds each column's type: whole numbers,
    numbers, true/false, else text, so a whole-number column of one file widens to that of
    another. Quoted cells may hold line breaks, and a large file is read by several tasks
    all the same (see ``csv_blocks``). Headers are read by opening the files, or with
    ``open_files=False`` (a store that only Spark reaches) taken from the records; only the
    different headers come to the driver. The cells are written once, as text.
    """
    records = csv_blocks.csv_records(csv_blocks.csv_lines(spark, path, "*.csv"))
    if open_files:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)  # content is not selected, so no file is opened
        headers = csv_blocks.csv_headers(found.select(F.col("_metadata.file_path").alias("path")))
    else:
        headers = records.where("first").select("file", F.col("record").alias("header"))
    headers = written(headers, "csv-headers")
    different = [r.header for r in headers.select("header").distinct().orderBy("header").collect()]
    if not different:
        raise FileNotFoundError(f"no CSV file with a header under {path}")
    widest = 1 + max(h.count(",") for h in different)
    named = spark.createDataFrame([(h,) for h in different], "header string").select("header", csv_blocks.cells(F.col("header"), widest).alias("names"))
    names = {r.header: [c for c in r.names] for r in named.collect()}
    for header, found in names.items():
        while found and found[-1] is None:
            found.pop()
        found[:] = [c if c is not None else f"_c{i}" for i, c in enumerate(found)]
        if len(set(found)) < len(found):
            raise ValueError(f"a header names a column twice: {header[:200]}")
    columns = list(dict.fromkeys(c for h in different for c in names[h]))
    by_header = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for h in different for x in (h, names[h])])
    rows = records.where(~F.col("first")).join(headers.withColumnRenamed("file", "of_file"), F.col("file") == F.col("of_file"), "left")
    unknown = F.raise_error(F.concat(F.lit("no header was read for "), F.col("file"))).cast("array<string>")
    texts = rows.select(csv_blocks.cells(F.col("record"), max(map(len, names.values()))).alias("cells"), F.coalesce(F.element_at(by_header, F.col("header")), unknown).alias("names")).select(
        *[F.get("cells", (F.array_position("names", F.lit(c)) - 1).cast("int")).alias(c) for c in columns]
    )
    known = texts.select(*[F.when(~F.trim(F.col(_quoted(c))).isin(MISSING_WORDS), F.col(_quoted(c))).alias(c) for c in columns])
    return _in_found_types(written(known, "csv-cells")).distinct()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _in_found_types(texts: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that all their cells have; columns without cells stay text.

    Whole numbers keep all digits: bigint, else decimal(38,0), else text.
    """
    whole = r"^\s*[+-]?\d+\s*$"
    kinds = {"bigint": whole, "decimal(38,0)": whole, "double": r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$", "boolean": r"^(True|TRUE|true|False|FALSE|false)$"}

    def fits(kind: str, col: Column) -> Column:
        if kind == "double":  # some cell has a point, an exponent or is infinite
            return F.bool_and(col.rlike(kinds[kind])) & ~F.bool_and(col.rlike(whole))
        held = F.trim(col).try_cast(kind).isNotNull() | col.isNull() if kinds[kind] == whole else F.lit(True)
        return F.bool_and(col.rlike(kinds[kind]) & held)

    checks = [fits(kind, F.col(_quoted(c))).alias(f"{i} {kind}") for i, c in enumerate(texts.columns) for kind in kinds]
    found = texts.agg(*checks).first()

    def typed(i: int, name: str) -> Column:
        kind = next((k for k in kinds if found[f"{i} {k}"]), None)
        col = F.col(_quoted(name))
        return (F.trim(col).cast(kind) if kind else col).alias(name)

    return texts.select(*[typed(i, c) for i, c in enumerate(texts.columns)])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, null_values: list[str] | None = None, on_error: str = "skip") -> DataFrame:
    """CSV with a header row in the given types.

    Null tokens become NULL. A row with an unreadable value or a wrong number of
    cells is skipped, or fails the query with ``on_error='abort'``. Quoted cells may hold
    line breaks; several tasks share a large file (see ``csv_blocks``).
    """
    tokens = NULL_TOKENS if null_values is None else null_values
    text = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields]
        + [T.StructField("_corrupt_record", T.StringType())]
    )
    records = csv_blocks.csv_records(csv_blocks.csv_lines(spark, path)).where(~F.col("first"))
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    parsed = F.from_csv("record", ", ".join(f"{_quoted(f.name)} string" for f in text.fields), options)
    rows = records.select(F.inline(F.array(parsed)))  # all cells, also where few are asked for: their number is checked
    cells = {f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name)) for f in schema.fields}
    typed = rows.select(
        "_corrupt_record",
        *[cells[f.name].alias(f"_raw_{f.name}") for f in schema.fields],
        *[cells[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields],
    )
    unreadable = reduce(
        lambda a, b: a | b,
        [F.col(f"_raw_{f.name}").isNotNull() & F.col(f.name).isNull() for f in schema.fields],
        F.col("_corrupt_record").isNotNull(),
    )
    names = [f.name for f in schema.fields]
    if on_error == "skip":
        return typed.filter(~unreadable).select(*names)
    if on_error != "abort":
        raise ValueError(f"unknown on_error {on_error!r}")
    checked = typed.withColumn("_checked", F.when(unreadable, F.raise_error("unreadable CSV row")).otherwise(F.lit(True)))
    return checked.filter(F.col("_checked").cast("boolean") | F.col("_checked").isNull()).select(*names)


def write_extractions(results: DataFrame, path: str, record_col: str = "extracted_json", name_col: str = "filename", as_name: str | None = None, as_record: str | None = None) -> None:
    """The ok rows as CSV with a header: the file (or patient) name and the JSON."""
    (
        results.filter(F.col("ok"))
        .select(F.col(name_col).alias(as_name or name_col), F.col(record_col).alias(as_record or record_col))
        .write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)
    )


def read_extractions(spark: SparkSession, path: str, name_col: str = "filename", record_col: str = "extracted_json") -> DataFrame:
    """What ``write_extractions`` wrote, records with line breaks whole."""
    schema = f"{name_col} string, {record_col} string"
    return spark.read.schema(schema).options(header="true", quote='"', escape='"', multiLine="true").csv(path)


# ---- parquet

def read_parquet_snapshots(spark: SparkSession, glob: str, casts: dict[str, str]) -> DataFrame:
    """All snapshot files of a glob with the listed columns in the listed types."""
    return spark.read.parquet(glob).select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])


def write_snapshot(df: DataFrame, root: str, stamp: str, csv_copy: bool = False) -> str:
    """A parquet snapshot named by its time stamp; optionally the same rows as CSV."""
    path = f"{root.rstrip('/')}/snapshot_{stamp}.parquet"
    df.write.mode("overwrite").parquet(path)
    if csv_copy:
        copy = df.sparkSession.read.schema(df.schema).parquet(path)
        copy.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path.replace(".parquet", ".csv"))
    return path


def incremental_filter(df: DataFrame, column: str, as_of, lookback: str = "1 day") -> DataFrame:
    """Rows changed since ``as_of`` minus the look-back; reaches the scan as a pushed filter."""
    since = F.lit(str(as_of)).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")
    return df.filter(F.col(column) >= since)


# ---- JSON batches

def write_json_batches(df: DataFrame, path: str, size: int = 100) -> None:
    """JSON lines, ``size`` records per file (a task's last file may have fewer); what is in the folder is replaced."""
    fs, p = hadoop_path(df.sparkSession, path)
    fs.delete(p, True)
    _write_small(df.select(F.lit("").alias("folder"), F.to_json(F.struct("*")).alias("text")), path, ".json", size)


def read_json_batches(spark: SparkSession, path: str, schema: T.StructType | str, array_files: bool = False) -> DataFrame:
    """Batches read back as one table; ``array_files`` for files that hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", str(array_files).lower()).json(path)


# ---- files, documents, logs

def _store(uri: str) -> tuple[stores.FileSystem, str]:
    """The Arrow file system of a qualified Hadoop path, and the path in it."""
    if uri.startswith("file:"):
        return _opened("file:")[0], "/" + uri[len("file:"):].lstrip("/")
    top, path = re.fullmatch("([^:]+://[^/]*)(.*)", uri, re.DOTALL).groups()
    store, base = _opened(re.sub("^s3[an]:", "s3:", top) + "/")
    return store, base.rstrip("/") + path


@cache
def _opened(uri: str) -> tuple[stores.FileSystem, str]:
    return (stores.LocalFileSystem(), "") if uri == "file:" else stores.FileSystem.from_uri(uri)


def _write_small(lines: DataFrame, root: str, suffix: str, size: int | None = None, own_folder: bool = True) -> None:
    """The lines (folder, text) of a task in files by folder, of ``size`` lines at most; neighbours in a folder share a file.

    Without ``own_folder`` the last part of ``folder`` begins the names of its files instead. For very many small files. Each task writes its own straight to their place, so there is no
    commit in which the driver moves them one by one. Their names are made of partition and
    number: another attempt of a task writes the same files again.
    """
    begin = "/part" if own_folder else ""
    fs, p = hadoop_path(lines.sparkSession, root)
    fs.mkdirs(p)
    uri = fs.makeQualified(p).toString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(uri)
        part, files, held, at, out, made = TaskContext.get().partitionId(), 0, 0, None, None, ""
        for batch in batches:
            for folder, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None or folder != at or held == size:
                    if out is not None:
                        out.close()
                    name = f"{folder or ''}{begin}-{part:05d}-{files:06d}{suffix}".lstrip("/")
                    if (parent := name.rpartition("/")[0]) != made:
                        store.create_dir(f"{base}/{parent}")
                        made = parent
                    out = store.open_output_stream(f"{base}/{name}")
                    files, held, at = files + 1, 0, folder
                out.write(((text or "") + "\n").encode("utf-8", "surrogatepass"))
                held += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    lines.select("folder", "text").mapInArrow(run, "files long").agg(F.sum("files")).collect()


def write_text_files(lines: DataFrame, root: str, suffix: str = ".txt", own_folder: bool = True) -> None:
    """The rows (folder, text) as text files: one for each folder and task, each text ended by a line break.

    Without ``own_folder`` the last part of ``folder`` begins the file's name instead.
    """
    _write_small(lines.select("folder", "text").sortWithinPartitions("folder"), root, suffix, own_folder=own_folder)


def _entries(store: stores.FileSystem, place: str) -> Iterator[tuple[str, bool, int, int]]:
    """Name, whether a folder, length and time (ms) of what a folder holds; links are followed, those to nothing left out.

    A local folder is not held as a whole: it may have millions of files.
    """
    if not isinstance(store, stores.LocalFileSystem):
        for x in store.get_file_info(stores.FileSelector(place, allow_not_found=True)):
            yield x.base_name, x.type == stores.FileType.Directory, x.size or 0, (x.mtime_ns or 0) // 1_000_000
        return
    try:
        with os.scandir(place) as found:
            for x in found:
                try:
                    x.name.encode()  # Spark's readers do not see other names either
                    at = x.stat()
                    yield x.name, x.is_dir(), at.st_size, at.st_mtime_ns // 1_000_000
                except UnicodeEncodeError:
                    pass
                except OSError as e:
                    if e.errno not in (errno.ENOENT, errno.ELOOP):
                        raise
    except FileNotFoundError:
        pass


def _hidden(name: str) -> bool:
    """Names of files that Spark's readers pass over, and of folders but for these of parquet's."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


_FOUND = "folder boolean, path string, length long, modified long"


def _walker(wanted: Callable[[str, int], bool], entries: int, waiting: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists the given folders and those below, as far as ``entries`` and ``waiting`` go; the other folders are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, rows = entries, []

        def batch() -> pa.RecordBatch:
            made = _batch(rows, folder=pa.bool_(), path=pa.string(), length=pa.int64(), modified=pa.int64())
            rows.clear()
            return made

        for given in batches:
            for top in given.column(0).to_pylist():
                queue = deque([top])
                while queue:
                    at = queue.popleft()
                    for name, folder, length, modified in _entries(*_store(at)):
                        left -= 1
                        path = f"{at.rstrip('/')}/{name}"
                        if not folder:
                            if wanted(name, length):
                                rows.append((False, path, length, modified))
                        elif not _hidden(name) or name.startswith(("_metadata", "_common_metadata")):
                            if left > 0 and len(queue) <= waiting:
                                queue.append(path)
                            else:
                                rows.append((True, path, 0, 0))
                        if len(rows) >= 10_000:
                            yield batch()
                    if left <= 0 or len(queue) > waiting:
                        rows += [(True, x, 0, 0) for x in queue]
                        break
        if rows:
            yield batch()

    return run


def _batch(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def _listed(spark: SparkSession, root: str, suffix: str) -> DataFrame | None:
    """path, length and time (ms) of what Spark's readers find below a path or glob, listed by tasks; None if only they reach it.

    Spark's own listing ends in the driver, which then holds every file. Here tasks list folders
    and write what they find, round by round: folders that a task passes on are dealt out to the next.
    """
    fs, p = hadoop_path(spark, root)
    tops = [(s.isDirectory(), s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.globStatus(p) or []]
    try:
        store, place = _store(tops[0][1])
        if store.get_file_info(place).type == stores.FileType.NotFound:
            return None
    except (IndexError, OSError, ValueError, NotImplementedError):  # nothing there, or no store that Arrow opens
        return None
    pattern = re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(f"*{suffix}").compiled().pattern(), re.DOTALL)

    def wanted(name: str, length: int) -> bool:
        return length > 0 and not _hidden(name) and pattern.fullmatch(name) is not None

    listed = [spark.createDataFrame([t for t in tops if not t[0] and wanted(t[1].rsplit("/", 1)[1], t[2])], _FOUND)]
    folders = spark.createDataFrame([(t[1],) for t in tops if t[0]], "path string")
    number, limits, tasks = sum(t[0] for t in tops), LISTED_ALONE, 4 * spark.sparkContext.defaultParallelism
    while number:
        dealt = folders.repartition(min(number, max(tasks, number // LISTED_AT_ONCE[1])))
        found = written(dealt.mapInArrow(_walker(wanted, *limits), _FOUND), "files")
        listed.append(found.where(~F.col("folder")))
        folders, limits = found.where("folder").select("path"), LISTED_AT_ONCE
        number = folders.count()
    return reduce(DataFrame.unionAll, listed).drop("folder")


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """path, length and modification time of files by suffix, without '~$' temp files.

    No file is opened. Tasks list the folders (see ``_listed``) when this is called.
    """
    found = _listed(spark, root, suffix)
    if found is not None:
        found = found.select("path", "length", F.timestamp_millis("modified").alias("modificationTime"))
    else:
        found = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{suffix}").load(root)
            .select("path", "length", "modificationTime")
        )
    return found.filter(~F.startswith(F.element_at(F.split("path", "/"), -1), F.lit("~$")))


# What a path's URI has in another form, as Java writes it: all but letters, digits and some marks, of other alphabets only spaces.
_NOT_IN_URI = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]""")


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path and name (as in a URI) and the bytes of the files of the given paths."""
    kinds = {"path": pa.string(), "filename": pa.string(), "content": pa.binary()}
    rows, held = [], 0
    for given in batches:
        for path in given.column(0).to_pylist():
            store, place = _store(path)
            with store.open_input_stream(place, compression=None) as f:
                content = f.read()
            uri = _NOT_IN_URI.sub(lambda c: quote(c[0], safe=""), path)
            rows.append((uri, uri.rsplit("/", 1)[1], content))
            held += len(content)
            if held >= BYTES_AT_ONCE or len(rows) >= 10_000:
                yield _batch(rows, **kinds)
                rows, held = [], 0
    if rows:
        yield _batch(rows, **kinds)


def read_text_docs(spark: SparkSession, root: str, suffix: str = ".txt") -> DataFrame:
    """One row per whole text file below a folder: path, file name and text.

    Tasks list the folders when this is called (see ``_listed``) and read the files later. Files
    that may be compressed by their suffix are left to Spark's reader.
    """
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    plain = "." in suffix and not re.search(r"[\\{}\[\]*?]", suffix) and codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f"/x{suffix}")) is None
    found = _listed(spark, root, suffix) if plain else None
    if found is None:
        return (
            spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").text(root, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("filename"), F.col("value").alias("text"))
        )
    size = found.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    tasks = max(size.files // FILES_A_TASK, size.bytes // (128 << 20), min(size.files, 4 * spark.sparkContext.defaultParallelism), 1)
    read = found.select("path").repartition(tasks).mapInArrow(_read_files, "path string, filename string, content binary")
    return read.select("path", "filename", F.col("content").cast("string").alias("text"))


def collect_failed_logs(spark: SparkSession, root: str, dag_id: str, run_id: str, task_id: str, indices: DataFrame, attempt: int = 1) -> DataFrame:
    """The logs of the listed task indices with their place in the list; missing ones are marked.

    ``indices`` has list_order and map_index, and may be as long as it likes: it is joined to one
    scan of the task's logs of that attempt.
    """
    run = run_id.replace(COLON_STAND_IN, ":")
    folder = f"{root.replace(COLON_STAND_IN, ':').rstrip('/')}/dag_id={dag_id}/run_id={run}/task_id={task_id}"
    fs, p = hadoop_path(spark, folder)
    path = F.col("_metadata.file_path")
    logs = (
        # The filter is on the file's name, so other attempts are not opened.
        spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).where(path.rlike(rf"/map_index=-?[0-9]+/attempt={attempt}\.log(/[^/]*)?$"))
        .select(F.regexp_extract(path, r"/map_index=(-?\d+)/", 1).cast("int").alias("map_index"), F.col("value").alias("content"))
        if fs.exists(p) else spark.createDataFrame([], "map_index int, content string")
    )
    wanted = indices.select("list_order", F.col("map_index").cast("int").alias("map_index"))
    return wanted.join(logs, "map_index", "left").select(
        "list_order",
        "map_index",
        F.concat(F.lit(f"{folder}/map_index="), F.col("map_index"), F.lit(f"/attempt={attempt}.log")).alias("path"),
        F.col("content").isNotNull().alias("found"),
        F.coalesce("content", F.lit(MISSING_LOG)).alias("content"),
    )


# ---- GeoJSON

def read_geojson_points(spark: SparkSession, path: str, properties: list[str] | None = None, others: str = "raise") -> DataFrame:
    """One row per point feature: lon, lat and the properties as a map.

    A file of any size is read by several tasks (see ``geojson_blocks``). With ``properties``
    those are columns instead. A feature of another geometry fails the
    query, or with ``others='skip'`` is left out.
    """
    if others not in ("raise", "skip"):
        raise ValueError(f"unknown others {others!r}")
    # Coordinates of other geometries are arrays of arrays, so they are kept as text here.
    feature = "struct<type:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
    found = geojson_blocks.features(geojson_blocks.pieces(spark, path))
    # Other objects of the document (a reference system) are no features.
    features = found.select(F.from_json("feature", feature, {"mode": "FAILFAST"}).alias("f")).where("f.type = 'Feature'")
    kind = F.coalesce("f.geometry.type", F.lit("no geometry"))
    if others == "raise":
        problem = F.raise_error(F.concat(F.lit("feature that is no point: "), kind)).cast("boolean")
        features = features.filter(F.when(kind == "Point", True).otherwise(problem))
    else:
        features = features.filter(kind == "Point")
    place = F.from_json("f.geometry.coordinates", "array<double>")
    names = [F.col("f.properties").getItem(p).alias(p) for p in properties or []] or [F.col("f.properties").alias("properties")]
    return features.select(F.get(place, 0).alias("lon"), F.get(place, 1).alias("lat"), *names)


def read_json_schema(spark: SparkSession, path: str) -> dict:
    """A JSON Schema document (a small metadata file) as a dict."""
    return json.loads(spark.read.text(path, wholetext=True).head()["value"])
