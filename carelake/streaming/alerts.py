"""Hours in which a facility loaded nothing, told by timers while the stream runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

HOUR_MS = 3_600_000
ALERT = "facility_id string, hour_bucket timestamp_ntz, record_count bigint"
#: Keyed state with timers needs this store.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class QuietHours(StatefulProcessor):
    """Per facility the next hour to judge, and the later hours that had a row.

    A timer stands at the end of the wait for the next hour; it fires as the watermark passes
    it, which rows of any facility make it do. State is one number and the hours that are
    still open.
    """

    def __init__(self, quiet_hours: int):
        self.wait = quiet_hours * HOUR_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "hour bigint")
        self.seen = handle.getMapState("seen", "hour bigint", "n bigint")

    def _begin(self, hour: int) -> None:
        self.next.update((hour,))
        self.handle.registerTimer(hour + self.wait)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self._begin(int(initialState["first_hour"].min()))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        hours = {h for part in rows for h in part["hour"].astype("int64").unique().tolist()}
        if not self.next.exists():  # a facility that was not known
            self._begin(min(hours))
        first = self.next.get()[0]
        for hour in hours:
            if hour >= first:
                self.seen.updateValue((hour,), (1,))
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        hour, now, quiet = self.next.get()[0], timerValues.getCurrentWatermarkInMs(), []
        while hour + self.wait <= now:
            if self.seen.containsKey((hour,)):
                self.seen.removeKey((hour,))
            else:
                quiet.append(hour)
            hour += HOUR_MS
        self._begin(hour)
        if quiet:
            yield pd.DataFrame({"facility_id": key[0], "hour_bucket": pd.to_datetime(quiet, unit="ms"), "record_count": 0})

    def close(self) -> None:
        pass


def latency_alert_stream(loads: DataFrame, facilities: DataFrame, since, quiet_hours: int = 2, late: str = "0 seconds", time_col: str = "_loaded_at") -> DataFrame:
    """Facility and hour for each hour from ``since`` on without a row, once the watermark is ``quiet_hours`` past its start.

    Each facility of ``facilities`` is watched from ``since`` on, also if it never loads; one that
    is not listed from its first row on. ``late`` is how long rows may be late. The session needs
    the settings of ``STORE``.
    """
    at = F.col(time_col).cast("timestamp")
    hour = F.unix_millis(F.date_trunc("hour", at))
    first = F.unix_millis(F.date_trunc("hour", F.lit(str(since)).cast("timestamp")))
    rows = loads.select("facility_id", at.alias("at"), hour.alias("hour")).where(F.col("hour") >= first).withWatermark("at", late)
    watched = facilities.select("facility_id").distinct().withColumn("first_hour", first)
    return rows.groupBy("facility_id").transformWithStateInPandas(
        statefulProcessor=QuietHours(quiet_hours), outputStructType=ALERT, outputMode="Append", timeMode="EventTime", initialState=watched.groupBy("facility_id"),
    )
