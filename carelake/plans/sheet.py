"""The cleaned insurance sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sheet import blank_missing, coerce_date, coerce_mixed, coerce_numeric, normalize_headers


def clean_sheet(df: DataFrame) -> DataFrame:
    """Headers, numbers, dates and mixed cells in one projection over the sheet."""
    return blank_missing(coerce_mixed(coerce_date(coerce_numeric(normalize_headers(df)))))
