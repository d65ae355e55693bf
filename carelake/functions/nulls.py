"""Null rules of the warehouse dialect, spelled out as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(x, y) -> Column:
    """x / y, NULL where y is zero or NULL."""
    return F.try_divide(_c(x), _c(y))


def _all_present(cols) -> Column:
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def strict_greatest(*cols) -> Column:
    """greatest() that is NULL as soon as one argument is (Spark skips NULLs)."""
    return F.when(_all_present(cols), F.greatest(*[_c(c) for c in cols]))


def strict_least(*cols) -> Column:
    return F.when(_all_present(cols), F.least(*[_c(c) for c in cols]))


def blank_to_null(col) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def mean(col) -> Column:
    """Average as exact sum over count, in double.

    The sum of decimals and integers does not depend on the order in which
    partitions arrive, so the result is the same on every run.
    """
    return F.try_divide(F.sum(_c(col)).cast("double"), F.count(_c(col)))


def exact_mean(col) -> Column:
    """Average of money, rounded half-up to cents by decimal division."""
    total, n = F.sum(_c(col)).cast("decimal(30,2)"), F.count(_c(col)).cast("decimal(20,0)")
    return F.try_divide(total, n).cast("decimal(38,2)")


def sum_when(condition: Column, value, default=0) -> Column:
    return F.sum(F.when(condition, value).otherwise(default))


def count_when(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))
