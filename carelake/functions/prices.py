"""Prices read out of shop text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first number of a text, and the number after the currency.
FIRST_NUMBER = r"[\d,]+\.?\d*"
KES_NUMBER = r"(?i)KES\s*([\d,]+\.?\d*)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def price_first(col) -> Column:
    return _number(F.regexp_extract(_c(col), FIRST_NUMBER, 0))


def price_kes(col) -> Column:
    after = F.nullif(F.regexp_extract(_c(col), KES_NUMBER, 1), F.lit(""))
    return _number(F.coalesce(after, F.regexp_extract(_c(col), FIRST_NUMBER, 0)))


def price_digits(col) -> Column:
    """Digits and dots only, then the longest prefix that is a number."""
    kept = F.regexp_replace(_c(col), r"[^0-9.]", "")
    return F.regexp_extract(kept, r"^(?:\d+\.?\d*|\.\d+)", 0).try_cast("double")


def discount_pct(current, original) -> Column:
    """round((original - current) / original * 100, 2); NULL if either is missing or 0."""
    cur, orig = _c(current), _c(original)
    return F.when(
        (F.coalesce(cur, F.lit(0.0)) != 0) & (F.coalesce(orig, F.lit(0.0)) != 0),
        F.round((orig - cur) / orig * 100, 2),
    )


def price_swap(current, original) -> tuple[Column, Column]:
    """Only the original price shown: it is the current one."""
    cur, orig = _c(current), _c(original)
    only_original = cur.isNull() & orig.isNotNull()
    return (
        F.when(only_original, orig).otherwise(cur),
        F.when(only_original, F.lit(None).cast("double")).otherwise(orig),
    )
