"""The hourly load monitor over a stream: exact counts per hour, and a word about rows that come too late."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.dates import minute_diff
from ..functions.nulls import count_when
from .alerts import HOUR_MS

KEYS = ["hour_bucket", "facility_id", "module_source", "source_table"]
PART = (
    "kind string, hour_bucket timestamp_ntz, facility_id string, module_source string, source_table string, part int, "
    "record_count bigint, unique_records bigint, error_count bigint, first_load timestamp_ntz, last_load timestamp_ntz"
)


class HourOfLoads(StatefulProcessor):
    """What an hour has so far: its counts, and the hashes seen, so the distinct count is exact.

    A timer closes the hour; its counts go out and its state goes. Rows for an hour that the
    watermark has closed go out as counted late rows. The key holds a part of the hashes, so
    an hour of one busy table is many keys, whose counts add up.
    """

    def __init__(self, late_ms: int, kept_ms: int):
        # The watermark is ``kept_ms`` behind the newest row: until then rows reach this operator.
        self.closes = HOUR_MS + late_ms - kept_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "n bigint, errors bigint, first bigint, last bigint")
        self.hashes = handle.getMapState("hashes", "row_hash string", "n bigint")

    def _out(self, kind: str, key: tuple, n: int, unique: int | None, errors: int, first: int, last: int) -> pd.DataFrame:
        hour, facility, module, table, part = key
        at = lambda ms: pd.to_datetime([ms], unit="us")
        return pd.DataFrame({
            "kind": kind, "hour_bucket": pd.to_datetime([hour], unit="ms"), "facility_id": facility, "module_source": module, "source_table": table, "part": part,
            "record_count": n, "unique_records": pd.Series([unique], dtype="Int64"), "error_count": errors, "first_load": at(first), "last_load": at(last),
        })

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n, errors, first, last, hashes = 0, 0, None, None, set()
        for some in rows:
            n, errors = n + len(some), errors + int(some["bad"].sum())
            low, high = int(some["us"].min()), int(some["us"].max())
            first, last = (low, high) if first is None else (min(first, low), max(last, high))
            hashes.update(some["row_hash"].dropna().unique().tolist())
        closes = int(key[0]) + self.closes
        if closes <= timerValues.getCurrentWatermarkInMs():
            yield self._out("late", key, n, None, errors, first, last)
            return
        if self.counts.exists():
            n0, errors0, first0, last0 = self.counts.get()
            n, errors, first, last = n + n0, errors + errors0, min(first, first0), max(last, last0)
        else:
            self.handle.registerTimer(closes)
        self.counts.update((n, errors, first, last))
        for row_hash in hashes:
            self.hashes.updateValue((row_hash,), (1,))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, errors, first, last = self.counts.get()
        unique = sum(1 for _ in self.hashes.keys())
        self.counts.clear()
        self.hashes.clear()
        yield self._out("hour", key, n, unique, errors, first, last)

    def close(self) -> None:
        pass


def hourly_loads(raw: DataFrame, late_hours: int = 2, kept_hours: int = 72, parts: int = 16, time_col: str = "_loaded_at") -> DataFrame:
    """Per hour, facility, module and table the counts of its parts, once no row of the last ``late_hours`` is missing.

    Rows up to ``kept_hours`` late are told as ``kind`` late; older ones Spark leaves out. Add the
    parts up with ``monitor_report`` and ``late_report``. The session needs the settings of
    ``alerts.STORE``.
    """
    at = F.col(time_col).cast("timestamp")
    rows = raw.select(
        F.unix_millis(F.date_trunc("hour", at)).alias("hour"), "facility_id", "module_source", "source_table",
        F.pmod(F.xxhash64("row_hash"), F.lit(parts)).cast("int").alias("part"), at.alias("at"), F.unix_micros(at).alias("us"), "row_hash",
        F.coalesce(F.col("validation_status") != "VALID", F.lit(False)).alias("bad"),
    ).withWatermark("at", f"{kept_hours} hours")
    return rows.groupBy("hour", "facility_id", "module_source", "source_table", "part").transformWithStateInPandas(
        statefulProcessor=HourOfLoads(late_hours * HOUR_MS, kept_hours * HOUR_MS), outputStructType=PART, outputMode="Append", timeMode="EventTime",
    )


def monitor_report(parts: DataFrame) -> DataFrame:
    """The closed hours, as the batch monitor has them."""
    return parts.where("kind = 'hour'").groupBy(*KEYS).agg(
        F.sum("record_count").alias("record_count"), F.sum("unique_records").alias("unique_records"), F.sum("error_count").alias("error_count"),
        F.min("first_load").alias("first_load"), F.max("last_load").alias("last_load"), minute_diff(F.min("first_load"), F.max("last_load")).alias("load_duration_minutes"),
    )


def late_report(parts: DataFrame) -> DataFrame:
    """How many rows came after their hour was closed."""
    return parts.groupBy(*KEYS).agg(F.sum(F.when(F.col("kind") == "late", F.col("record_count"))).alias("late_records"), count_when(F.col("kind") == "late").alias("late_parts")).where("late_parts > 0").drop("late_parts")
