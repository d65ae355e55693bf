"""Tables described by a data dictionary: rows of module, table, field, type, null, key."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import model_namespace
from .dedup import first_per_key

INGESTED_AT = "_ingested_at"


def dictionary_models(rows: DataFrame, order: str, doubled: bool = False) -> DataFrame:
    """One row per (module, table), the first in dictionary order, with its namespace."""
    clean = rows.withColumns({"module": F.trim("module"), "table": F.trim("table")}).filter(
        (F.col("module") != "") & (F.col("table") != "")
    )
    first = first_per_key(clean, [F.lower("module"), F.lower("table")], [F.col(order).asc()])
    return first.withColumn("namespace", model_namespace("module", "table", doubled))


def spark_type(mysql_type: str, strict_numbers: bool = False) -> T.DataType:
    """The column type for a MySQL type name.

    Fixed values: tests in this order, by substring; so tinyint(1) is a number and
    char(n) a string by default.
    """
    name = str(mysql_type).lower()
    if "int" in name or "decimal" in name:
        scale = re.search(r"decimal\((\d+)\s*,\s*(\d+)\)", name)
        if scale and not strict_numbers:
            return T.DecimalType(int(scale[1]), int(scale[2]))
        return T.DecimalType(38, 0)
    rules = [
        (("float", "double"), T.DoubleType()),
        (("varchar", "text"), T.StringType()),
        (("datetime", "timestamp"), T.TimestampNTZType()),
        (("date",), T.DateType()),
        (("boolean",), T.BooleanType()),
    ]
    for words, kind in rules:
        if any(w in name for w in words):
            return kind
    return T.StringType()


def schema_from_dictionary(rows: list[dict], strict_numbers: bool = False) -> T.StructType:
    """Fields of one table plus the ingestion time."""
    fields = [
        T.StructField(r["field"], spark_type(r["type"], strict_numbers), r.get("null") == "YES")
        for r in rows
    ]
    return T.StructType(fields + [T.StructField(INGESTED_AT, T.TimestampNTZType())])


def primary_key(rows: list[dict]) -> list[str]:
    return [r["field"] for r in rows if str(r.get("key", "")).upper() == "PRI"]


def group_tables(rows: list[dict]) -> dict[str, list[dict]]:
    """Dictionary rows by table, with trimmed lower-case headers and '' for missing."""
    tables: dict[str, list[dict]] = {}
    for row in rows:
        clean = {k.strip().lower(): "" if v is None else v for k, v in row.items()}
        tables.setdefault(clean["table"], []).append(clean)
    return dict(sorted(tables.items()))
