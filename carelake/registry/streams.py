"""Streams run to the end of what is there, and what they leave behind."""

import contextlib

from pyspark.sql import functions as F

from ..plans.revenue import daily_kpis
from ..schemas import DAILY_METRICS, struct
from ..session import scratch_path
from ..sources.landing import keys_as_text
from ..sources.tables import Table
from ..streaming import alerts, ingest, monitor, refresh
from . import query
from .aggregates import labelled
from .files import _RAW_COLUMNS, _RAW_SQL, landed

_HALF = "2024-01-16 00:00:00"
_STREAM = ["event_id", "facility_id", "patient_id", "event_time", "event_category", "validation_status", "amount"]


def _half(t, later: bool):
    clean = labelled(t).select(*_STREAM, "ingested_at")
    first = F.col("ingested_at") < F.lit(_HALF).cast("timestamp_ntz")
    return clean.filter(~first if later else first).drop("ingested_at")


def _folders(t, label: str, *names: str) -> list[str]:
    root = scratch_path(t.spark, label)
    return [f"{root}/{n}" for n in names]


@query(_RAW_SQL)
def str_auto_ingest(t):
    raw, checkpoint = _folders(t, "ingest", "raw", "checkpoint")
    root = landed(t, "run-1")
    # The second start finds nothing new.
    for _ in range(2):
        ingest.auto_ingest(t.spark, root, raw, checkpoint).awaitTermination()
    with keys_as_text(t.spark):
        rows = t.spark.read.parquet(raw)
    return rows.select(F.try_variant_get("payload", "$.id", "string").alias("id"), *_RAW_COLUMNS)


@contextlib.contextmanager
def _keyed_state(spark):
    """The state store that keyed state with timers needs, for the streams started in the block."""
    before = {k: spark.conf.get(k) for k in alerts.STORE}
    try:
        for k, v in alerts.STORE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_LATE = "(md5(row_hash) < '2' AND _loaded_at < TIMESTAMP '2024-01-30 06:00:00')"


@query(f"""
SELECT date_trunc('hour', _loaded_at) AS hour_bucket, facility_id, module_source, source_table, COUNT(*) FILTER (NOT {_LATE}) AS record_count,
       COUNT(DISTINCT row_hash) FILTER (NOT {_LATE}) AS unique_records, COUNT(*) FILTER (NOT {_LATE} AND validation_status <> 'VALID') AS error_count,
       MIN(_loaded_at) FILTER (NOT {_LATE}) AS first_load, MAX(_loaded_at) FILTER (NOT {_LATE}) AS last_load,
       date_diff('minute', MIN(_loaded_at) FILTER (NOT {_LATE}), MAX(_loaded_at) FILTER (NOT {_LATE})) AS load_duration_minutes, COUNT(*) FILTER ({_LATE}) AS late_records
FROM fx_loads WHERE _loaded_at >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY 1, 2, 3, 4
HAVING hour_bucket + INTERVAL 3 HOUR <= (SELECT MAX(_loaded_at) FROM fx_loads)
""")
def str_hourly_monitor_stream(t):
    # Some rows of the first hours arrive with the second start, when their hours are closed.
    folder, out, checkpoint = _folders(t, "monitor", "loads", "out", "checkpoint")
    loads = t("fx_loads").filter(F.col("_loaded_at") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"))
    late = (F.md5("row_hash") < "2") & (F.col("_loaded_at") < F.lit("2024-01-30 06:00:00").cast("timestamp_ntz"))
    noon = F.col("_loaded_at") < F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    with _keyed_state(t.spark):
        for part in (loads.filter(noon & ~late), loads.filter(~noon | late)):
            part.write.mode("append").parquet(folder)
            arriving = t.spark.readStream.schema(loads.schema).parquet(folder)
            ingest.drain(monitor.hourly_loads(arriving, parts=2), out, checkpoint).awaitTermination()
    parts = t.spark.read.schema(monitor.PART).parquet(out)
    both = monitor.monitor_report(parts).join(monitor.late_report(parts), monitor.KEYS, "full")
    counts = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("record_count", "unique_records", "error_count", "late_records")}
    return both.withColumns(counts)


_EARLY = """(SELECT facility_id, CASE WHEN hour(_loaded_at) % 6 = CAST(substr(facility_id, 2) AS INT) THEN _loaded_at - INTERVAL 1 HOUR ELSE _loaded_at END AS came FROM fx_loads)"""


@query(f"""
SELECT f.facility_id, h.hour_bucket, CAST(0 AS BIGINT) AS record_count
FROM (SELECT DISTINCT facility_id FROM fx_loads UNION ALL SELECT 'never') f
JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-30 00:00:00', TIMESTAMP '2024-01-31 12:00:00', INTERVAL 1 HOUR)) AS hour_bucket) h
  ON h.hour_bucket + INTERVAL 2 HOUR <= (SELECT MAX(came) FROM {_EARLY} e)
LEFT JOIN {_EARLY} l ON l.facility_id = f.facility_id AND date_trunc('hour', l.came) = h.hour_bucket
WHERE l.facility_id IS NULL
""")
def str_latency_alert_stream(t):
    # As in the batch query, loads of every sixth hour come an hour early; one facility never loads.
    folder, out, checkpoint = _folders(t, "alerts", "loads", "out", "checkpoint")
    own = F.hour("_loaded_at") % 6 == F.expr("CAST(substr(facility_id, 2) AS INT)")
    early = F.col("_loaded_at") - F.expr("INTERVAL 1 HOUR")
    loads = t("fx_loads").select("facility_id", F.when(own, early).otherwise(F.col("_loaded_at")).alias("_loaded_at"))
    facilities = loads.select("facility_id").union(t.spark.range(1).select(F.lit("never").alias("facility_id")))
    noon = F.col("_loaded_at") < F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    with _keyed_state(t.spark):
        for part in (loads.filter(noon), loads.filter(~noon)):  # the second start goes on from the checkpoint
            part.write.mode("append").parquet(folder)
            arriving = t.spark.readStream.schema(loads.schema).parquet(folder)
            quiet = alerts.latency_alert_stream(arriving, facilities, "2024-01-30 00:00:00")
            ingest.drain(quiet, out, checkpoint).awaitTermination()
    return t.spark.read.schema(alerts.ALERT).parquet(out)


_COLUMNS = "event_id, facility_id, patient_id, event_time, amount"


@query(f"SELECT {_COLUMNS} FROM fx_clean_events WHERE ingested_at >= TIMESTAMP '{_HALF}'")
def str_append_cdc(t):
    table, batches, checkpoint = _folders(t, "cdc", "table", "batches", "checkpoint")
    _half(t, False).write.parquet(table)
    changes = ingest.append_changes(t.spark, table, _half(t, False).schema)
    ingest.drain_batches(changes, batches, checkpoint)
    _half(t, True).write.mode("append").parquet(table)
    # The checkpoint holds the offset: the second reading has the new rows only.
    new = ingest.drain_batches(changes, batches, checkpoint)
    return t.spark.read.schema(changes.schema).parquet(*new).select(*_COLUMNS.split(", "))


@query(f"SELECT {_COLUMNS} FROM fx_clean_events")
def str_initial_rows(t):
    table, out, checkpoint = _folders(t, "initial", "table", "out", "checkpoint")
    changes = None
    for later in (False, True):
        part = _half(t, later)
        part.write.mode("append").parquet(table)
        changes = changes or ingest.append_changes(t.spark, table, part.schema)
        ingest.drain(changes, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out).select(*_COLUMNS.split(", "))


@query(f"""
SELECT metric_date, facility_id, total_encounters, unique_patients, avg_revenue_per_encounter FROM ox_metrics,
  (SELECT MAX(event_time) FILTER (WHERE ingested_at < TIMESTAMP '{_HALF}') AS first, MAX(event_time) AS last FROM fx_clean_events)
WHERE metric_date BETWEEN CAST(first - INTERVAL 24 HOUR AS DATE) AND CAST(first AS DATE) OR metric_date >= CAST(last - INTERVAL 24 HOUR AS DATE)
""")
def str_refresh_merge(t):
    table, out, checkpoint = _folders(t, "refresh", "clean", "metrics", "checkpoint")
    metrics = Table(t.spark, out, struct(DAILY_METRICS))
    for later in (False, True):
        _half(t, later).write.mode("append").parquet(table)
        events = ingest.append_changes(t.spark, table, _half(t, later).schema)
        read = lambda: t.spark.read.parquet(table)
        refresh.refresh_on_arrival(events, read, metrics, checkpoint).awaitTermination()
    return metrics.read().select("metric_date", "facility_id", "total_encounters", "unique_patients", "avg_revenue_per_encounter")


@query("""
SELECT CAST(event_time AS DATE) AS date, facility_id, COUNT(DISTINCT patient_id) AS unique_patients,
       CAST(SUM(CASE WHEN validation_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid_records FROM ox_labelled GROUP BY 1, 2
""")
def str_mv_refresh(t):
    (root,) = _folders(t, "views", "kpis")
    state = {"rows": _half(t, False)}
    views = refresh.Materialized()
    views.register("kpis", lambda: daily_kpis(state["rows"]), root)
    views.refresh()
    state["rows"] = labelled(t)
    views.refresh(["kpis"])
    return views.read(t.spark, "kpis").select("date", "facility_id", "unique_patients", "valid_records")


@query("SELECT facility_id, MAX(ingested_at) AS updated_since FROM fx_clean_events GROUP BY 1")
def str_watermark(t):
    (root,) = _folders(t, "watermark", "state")
    events = t("fx_clean_events").select("facility_id", "ingested_at")
    refresh.advance_watermarks(events, root)
    # An older load does not move the marks back.
    refresh.advance_watermarks(events.filter(F.col("ingested_at") < F.lit(_HALF).cast("timestamp_ntz")), root)
    return refresh.read_watermarks(t.spark, root)
