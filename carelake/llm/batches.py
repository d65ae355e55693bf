"""Rows through Arrow batches, a bounded slice at a time, and the words of a text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows turned into Python values at once.
SLICE_ROWS = 512
#: How to empty what a module keeps in this Python worker between its tasks, by the module's name.
kept: dict[str, Callable[[], None]] = {}


def release_others(module: str) -> None:
    """Empties what modules other than this one keep: a worker that Spark gives to another operator holds the caches of one only."""
    for name, empty in kept.items():
        if name != module:
            empty()


def words(text: str | None) -> list[bytes]:
    """Runs of anything but space and U+0009 to U+000D, as UTF-8 (``bytes.split`` has just these six)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def map_rows(df: DataFrame, columns: list[str], rows: Callable[[list[tuple]], list[tuple]], schema: T.StructType) -> DataFrame:
    """``rows`` over slices of the named columns, in order; it may return any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(rows.__module__)
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = rows(list(zip(*(part.column(i).to_pylist() for i in range(part.num_columns)), strict=True)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, type=field.type) for values, field in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow
                    )

    return df.select(*[df[c] for c in columns]).mapInArrow(run, schema)


def filter_rows(df: DataFrame, columns: list[str], keep: Callable[[list[tuple]], list[bool]]) -> DataFrame:
    """The rows for which ``keep`` says so, with all their columns."""
    at = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(keep.__module__)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                kept = keep(list(zip(*(part.column(i).to_pylist() for i in at), strict=True)))
                yield part.filter(pa.array(kept, type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
