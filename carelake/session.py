"""Session settings and the shared scratch folder for written intermediates."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_scratch: dict[str, str] = {}
_shipped: set[str] = set()
#: Paths written and not yet removed, with the file system of each.
_left: dict[str, tuple] = {}
_blocks = threading.local()
#: Shuffle files of a written intermediate are of no use once it is written.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "carelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects: UTC, ANSI, AQE.

    ``master`` is only given for local runs; on a cluster spark-submit sets it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Put this package on the Python path of the executors (as --py-files would)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="carelake-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "carelake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; on a
    cluster the executors would each write to their own disk, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="carelake-scratch-")
        atexit.register(shutil.rmtree, _own_scratch[app], ignore_errors=True)
    return _own_scratch[app]


def spread(scan: DataFrame) -> DataFrame:
    """A scan ahead of costly work per row, over at least as many tasks as there are cores.

    Only a few small files are ever redistributed; a large table has more splits than
    cores and stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _open_blocks() -> list[list[str]]:
    if not hasattr(_blocks, "open"):
        _blocks.open = []
    return _blocks.open


def _remove(paths: list[str]) -> None:
    for path in paths:
        with contextlib.suppress(Exception):  # the session may be gone; the folder is then left to its owner
            fs, p = _left.pop(path)
            fs.delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what ``written`` and ``scratch_path`` made in the block when it ends.

    A DataFrame that still reads such a table can't be used afterwards: write the block's
    result with ``written(..., outer=True)``, which leaves it to the block around, or to the
    end of the application.
    """
    _open_blocks().append([])
    try:
        yield
    finally:
        _remove(_open_blocks().pop())


@atexit.register
def _remove_all() -> None:
    _remove(list(_left))


def scratch_path(spark: SparkSession, label: str, outer: bool = False) -> str:
    """A new path in the scratch folder, removed with the ``scratch`` block or the application."""
    path = f"{scratch_dir(spark)}/carelake-{label}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    _left[path] = (fs, p)
    blocks = _open_blocks()
    if len(blocks) > outer:
        blocks[-2 if outer else -1].append(path)
    return path


def written(df: DataFrame, label: str, outer: bool = False) -> DataFrame:
    """Write ``df`` to the scratch folder (a job runs now) and return a reader of it.

    Used where a result must stay the same over several reads (positions given to rows) or
    where lineage must be cut. Parquet in the shared folder survives lost executors and
    keeps column pruning; it is removed with the ``scratch`` block it was made in, or when
    the application ends. The shuffle files of the job go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, outer)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
