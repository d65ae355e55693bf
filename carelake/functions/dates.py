"""Date arithmetic that counts calendar boundaries.

Spark's own ``timestampdiff`` counts whole elapsed units (23:59 to 00:01 is zero
days); the pipelines count the boundaries crossed (one day).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_diff(start, end) -> Column:
    return (F.year(_c(end)) - F.year(_c(start))).cast("bigint")


def day_diff(start, end) -> Column:
    return F.datediff(_c(end).cast("date"), _c(start).cast("date")).cast("bigint")


def _epoch_units(col, seconds: int) -> Column:
    return F.floor(F.unix_seconds(_c(col).cast("timestamp")) / F.lit(seconds))


def hour_diff(start, end) -> Column:
    return _epoch_units(end, 3600) - _epoch_units(start, 3600)


def minute_diff(start, end) -> Column:
    return _epoch_units(end, 60) - _epoch_units(start, 60)


def day(col) -> Column:
    return _c(col).cast("date")


def week_start(col) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(day(col), "week")


def month_start(col) -> Column:
    return F.trunc(day(col), "month")


def hour_start(col) -> Column:
    return F.date_trunc("hour", _c(col)).cast("timestamp_ntz")


def add_days(col, n: int) -> Column:
    return F.date_add(day(col), n)


def add_months(col, n: int) -> Column:
    return F.add_months(day(col), n)


def add_hours(col, n: int) -> Column:
    return _c(col) + F.make_dt_interval(hours=F.lit(n))


def as_of_column(as_of) -> Column:
    """A literal instant: every 'current time' in a dataset is an argument."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def epoch_local(col, zone: str = "Africa/Nairobi") -> Column:
    """Epoch seconds or milliseconds as local wall-clock time.

    Fixed value: above 10,000,000,000 the number is taken as milliseconds.
    """
    c = _c(col).cast("bigint")
    instant = F.when(c > F.lit(10_000_000_000), F.timestamp_millis(c)).otherwise(
        F.timestamp_seconds(c)
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant.cast("timestamp_ntz"))
