"""Tables on plain files: small ones in versions, partitioned ones by Spark's dynamic partition overwrite.

A table without partitions is rewritten whole: every write is a new folder ``__version=<number>``
that counts from the moment the job commit puts its ``_SUCCESS`` file there, so a reader never
sees half a write and a failed one leaves the table as it was. A partitioned table is one folder;
a merge stages its rows and then overwrites the partitions it touches, which readers should
not do at the same time. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import merge_upsert
from ..schemas import TABLES, struct
from ..session import hadoop_path, scratch, written


class Table:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: list[str] | None = None, sort_by: list[str] | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by, self.sort_by = partition_by or [], sort_by or []

    def versions(self) -> list[int]:
        """The committed versions of a table without partitions."""
        fs, root = hadoop_path(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        there = lambda name: fs.exists(hadoop_path(self.spark, f"{self.root}/{name}/_SUCCESS")[1])
        return sorted(int(n.removeprefix("__version=")) for n in names if n.startswith("__version=") and there(n))

    def _dir(self, version: int) -> str:
        return f"{self.root}/__version={version:08d}"

    def _exists(self) -> bool:
        fs, marker = hadoop_path(self.spark, f"{self.root}/_SUCCESS")
        return fs.exists(marker) if self.partition_by else bool(self.versions())

    def ensure(self) -> "Table":
        """Create the table empty if it is absent."""
        if not self._exists():
            self.replace(self.spark.createDataFrame([], self.schema))
        return self

    def read(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], self.schema)
        path = self.root if self.partition_by else self._dir(self.versions()[-1])
        return self.spark.read.schema(self.schema).parquet(path).select(*[f.name for f in self.schema.fields])

    def _write(self, df: DataFrame, path: str, **options: str) -> None:
        out = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if self.partition_by:
            # REBALANCE lets AQE split a hot partition over several files and tasks.
            out = out.hint("rebalance", *self.partition_by)
        if self.sort_by:
            out = out.sortWithinPartitions(*self.partition_by, *self.sort_by)
        out.write.mode("overwrite").options(**options).partitionBy(*self.partition_by).parquet(path)

    def replace(self, df: DataFrame, keep: int = 2) -> "Table":
        """``df`` as the new content; of a table without partitions the last ``keep`` versions stay."""
        if self.partition_by:
            with scratch(self.spark):
                # The new content may be made of the old: it is staged before that goes.
                self._write(written(df, "table-replace"), self.root, partitionOverwriteMode="static")
            return self
        versions = self.versions()
        self._write(df, self._dir(max(versions, default=0) + 1))
        for old in versions[: len(versions) + 1 - keep]:
            fs, path = hadoop_path(self.spark, self._dir(old))
            fs.delete(path, True)
        return self

    def merge(self, source: DataFrame, keys: list, update_cols: list[str], keep: int = 2, **options) -> "Table":
        """``merge_upsert`` of ``source``; of a partitioned table only the partitions it touches are written.

        Those hold a key of the source or get one of its rows; they are found by a join. The
        folders of those that lose their last row are removed after the write.
        """
        with scratch(self.spark):
            if not self.partition_by or not self._exists():
                return self.replace(merge_upsert(self.read(), source, keys, update_cols, **options), keep)
            parts, staged = self.partition_by, written(source, "table-merge")
            folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
            stored = self.spark.read.schema(self.schema).parquet(self.root).select(*self.schema.names, folder)
            names = [f"_k{i}" for i in range(len(keys))]
            of = lambda df: [(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names, strict=True)]
            hit = stored.select(*parts, *of(stored)).join(staged.select(*of(staged)), names, "left_semi").select(*parts)
            stamped = {*(options.get("on_update") or {}), *(options.get("on_insert") or {})}
            if all(c in staged.columns and c not in stamped for c in parts):
                hit = hit.union(staged.select(*[staged[c].cast(self.schema[c].dataType) for c in parts]))
                touched = written(hit.distinct().withColumnsRenamed({c: f"_t_{c}" for c in parts}), "table-touched")
                same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts])
                stored = stored.join(touched, same, "left_semi")
            # Else where new rows go is not known before they are made, and all partitions are written.
            merged = written(merge_upsert(stored.drop("_folder"), staged, keys, update_cols, **options), "table-merged")
            left = merged.select(*[F.col(c).alias(f"_t_{c}") for c in parts]).distinct()
            gone = stored.join(left, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts]), "left_anti").select("_folder").distinct()
            emptied = [r["_folder"] for r in gone.collect()]  # no more than folders
            self._write(merged, self.root, partitionOverwriteMode="dynamic")
            for path in emptied:
                fs, p = hadoop_path(self.spark, self.spark._jvm.java.net.URI(path).getPath() if path.startswith("file:") else path)
                fs.delete(p, True)
            return self


def open_table(spark: SparkSession, lake: str, name: str) -> Table:
    """A table of the lake by name, in its columns and layout."""
    ddl, folders, order = TABLES[name]
    return Table(spark, f"{lake.rstrip('/')}/{name}", struct(ddl), folders, order)


Reader = Callable[[str], DataFrame]
