"""Documents that are awkward on purpose, shared by the tests."""

from __future__ import annotations

from pyspark.sql import types as T

from conftest import SF_DIR

#: Extra columns have names that operators might use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, key string, n long, length long, rid long, score double"


def documents(spark, *more):
    line = "one line of words that stands in several documents of this small set"
    rows = [
        (1, f"{line}\nshort one", "a"), (2, f"{line}\nother words follow here in this text", "a"),
        (3, line.replace("several", "many"), "b"), (3, line.replace("several", "many"), "b"),
        (4, None, None), (5, "", "b"), (6, " \t\n\n ", "c"), (None, "a document without an id but with some words in it", None),
        (None, None, None), (7, "word " * 30_000, "c"), (8, "Êtes-vous là ? déjà\xa0vu\u2003 😀 " * 40, "é"), (9, "x" * 50_000, "z"),
        (10, line, "a"), (11, line.upper(), "c"), *more,
    ]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, False, "k", 3, 4, 5, 0.5) for i, t, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def plain(df, *columns):
    """Rows as tuples in order of their text."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def unchanged_columns(before, after):
    assert after.columns == before.columns
    assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


LABELS = T.StructType([T.StructField(c, T.IntegerType() if c != "doc_id" else T.LongType()) for c in ("doc_id", "quality", "toxic")])
