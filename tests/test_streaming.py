"""Streams give what the batch gives over the same files."""

import datetime as dt

from pyspark.sql import functions as F

from carelake.plans.mart import daily_facility_metrics
from carelake.plans.quality import hourly_load_monitor
from carelake.schemas import DAILY_METRICS, struct
from carelake.sources.landing import read_raw_landing, register_external, write_raw_landing
from carelake.sources.tables import Table
from carelake.streaming import alerts, ingest, refresh
from conftest import rows


def land(spark, root, run, *ids):
    df = spark.createDataFrame([(f"f{i % 2}", "m", "t", "n", "2024-01-02", f'{{"id":"{i}"}}') for i in ids] + [("f0", "m", "t", "n", "2024-01-02", "bad")],
                               "facility_id string, module string, table string, namespace string, dt string, line string")
    write_raw_landing(df, root, run)


def test_auto_ingest_takes_each_file_once(spark, tmp_path):
    landing, raw, ckpt = (str(tmp_path / d) for d in ("landing", "raw", "ckpt"))
    land(spark, landing, "r1", 1, 2, 3)
    ingest.auto_ingest(spark, landing, raw, ckpt).awaitTermination()
    ingest.auto_ingest(spark, landing, raw, ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 3
    land(spark, landing, "r2", 4, 5)
    ingest.auto_ingest(spark, landing, raw, ckpt).awaitTermination()
    batch = read_raw_landing(spark, landing)
    columns = ["facility_id", "source_table", "row_hash"]
    assert rows(spark.read.parquet(raw), *columns) == rows(batch, *columns)


def test_landed_files_move_to_the_archive(spark, tmp_path):
    landing, raw, ckpt, archive = (str(tmp_path / d) for d in ("landing", "raw", "ckpt", "archive"))
    left = lambda: sum(1 for p in (tmp_path / "landing").rglob("part-*"))
    found = []
    for run in range(4):
        land(spark, landing, f"r{run}", 2 * run, 2 * run + 1)
        ingest.auto_ingest(spark, landing, raw, ckpt, archive=archive).awaitTermination()
        found.append((left(), spark.read.parquet(raw).count()))
        both = register_external(spark, landing, "both", archive)
        ids = both.select(F.try_variant_get("payload", "$.id", "string").alias("id"))
        assert rows(ids) == [(str(i),) for i in range(2 * run + 2)]  # none twice, none lost
    assert [n for _, n in found] == [2, 4, 6, 8]
    assert found[-1][0] <= found[0][0] * 2 and any((tmp_path / "archive").rglob("part-*"))


def test_changes_with_initial_rows_and_append_only(spark, tmp_path):
    table, out, ckpt = (str(tmp_path / d) for d in ("table", "out", "ckpt"))
    schema = "id bigint"
    spark.range(3).write.parquet(table)
    changes = ingest.append_changes(spark, table, spark.range(0).schema)
    ingest.drain(changes, out, ckpt).awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 3
    spark.range(3, 5).write.mode("append").parquet(table)
    ingest.drain(changes, out, ckpt).awaitTermination()
    assert rows(spark.read.schema(schema).parquet(out)) == [(i,) for i in range(5)]


CLEAN = "event_id string, facility_id string, patient_id string, event_time timestamp_ntz, amount decimal(38,2)"


def clean_rows(spark, *data):
    return spark.createDataFrame([(e, "f", p, at, None) for e, p, at in data], CLEAN)


def test_refresh_on_arrival(spark, tmp_path):
    table, ckpt = str(tmp_path / "clean"), str(tmp_path / "ckpt")
    metrics = Table(spark, str(tmp_path / "metrics"), struct(DAILY_METRICS))
    d1, d2 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 3, 5)
    clean_rows(spark, ("1", "a", d1), ("2", "a", d1), ("2", "b", d1)).write.parquet(table)
    read = lambda: spark.read.parquet(table)

    def run():
        events = spark.readStream.schema(read().schema).parquet(table)
        refresh.refresh_on_arrival(events, read, metrics, ckpt).awaitTermination()

    run()
    assert rows(metrics.read(), "metric_date", "total_encounters", "unique_patients") == [(dt.date(2024, 1, 1), 2, 2)]
    clean_rows(spark, ("3", "a", d2)).write.mode("append").parquet(table)
    run()
    columns = ["metric_date", "facility_id", "total_encounters", "unique_patients", "avg_revenue_per_encounter"]
    assert rows(metrics.read(), *columns) == rows(daily_facility_metrics(read(), "2024-01-04 00:00:00"), *columns)
    updated = refresh.refresh_aggregates(read(), metrics, d2).read()
    assert rows(updated, *columns) == rows(metrics.read(), *columns)
    assert updated.filter("updated_at is not null").count() == 1


def test_materialized_refresh(spark, tmp_path):
    data = {"n": 3}
    views = refresh.Materialized()
    views.register("ids", lambda: spark.range(data["n"]), str(tmp_path / "ids"))
    assert views.refresh() == ["ids"]
    data["n"] = 5
    assert views.read(spark, "ids").count() == 3
    views.refresh(["ids"])
    assert views.read(spark, "ids").count() == 5


def test_watermark(spark, tmp_path):
    root = str(tmp_path / "wm")
    assert refresh.get_watermark(spark, root, "f1") == "1970-01-01 00:00:00"
    refresh.set_watermark(spark, root, "f1", "2024-01-02 03:04:05")
    refresh.set_watermark(spark, root, "f2", "2024-01-01 00:00:00")
    refresh.set_watermark(spark, root, "f1", "2024-01-03 00:00:00")
    assert refresh.get_watermark(spark, root, "f1") == "2024-01-03 00:00:00"
    assert refresh.get_watermark(spark, root, "f2") == "2024-01-01 00:00:00"
    loads = spark.createDataFrame(
        [("f1", dt.datetime(2024, 1, 1)), ("f2", dt.datetime(2024, 2, 1)), ("f2", dt.datetime(2024, 1, 9)), ("f3", dt.datetime(2024, 1, 5)), (None, dt.datetime(2024, 1, 5))],
        "facility_id string, ingested_at timestamp_ntz",
    )
    refresh.advance_watermarks(loads, root)
    marks = dict(refresh.read_watermarks(spark, root).collect())
    assert marks == {"f1": dt.datetime(2024, 1, 3), "f2": dt.datetime(2024, 2, 1), "f3": dt.datetime(2024, 1, 5)}


def test_hourly_stream_equals_batch(spark, tmp_path, inputs):
    loads = inputs("fx_loads").withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp"))
    path = str(tmp_path / "loads")
    loads.write.parquet(path)
    stream = ingest.hourly_load_stream(spark.readStream.schema(loads.schema).parquet(path))
    query = stream.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    columns = ["hour_bucket", "facility_id", "module_source", "source_table", "record_count"]
    batch = hourly_load_monitor(inputs("fx_loads"), "2024-01-31 00:00:00", lookback_days=60)
    assert rows(spark.table("hourly"), *columns) == rows(batch, *columns)


def test_quiet_hours_fire_without_rows(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / d) for d in ("loads", "out", "ckpt"))
    for name, value in alerts.STORE.items():
        spark.conf.set(name, value)
    facilities = spark.createDataFrame([("a",), ("b",), ("c",)], "facility_id string")
    found = {}

    def run(*loads):
        frame = spark.createDataFrame([(f, dt.datetime(2024, 1, 30, h, m)) for f, h, m in loads], "facility_id string, _loaded_at timestamp")
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = alerts.latency_alert_stream(spark.readStream.schema(frame.schema).parquet(folder), facilities, "2024-01-30 00:00:00")
        ingest.drain(stream, out, ckpt).awaitTermination()
        found.clear()
        for r in spark.read.parquet(out).collect():
            found.setdefault(r.facility_id, []).append(r.hour_bucket.hour)
        return {k: sorted(v) for k, v in found.items()}

    try:
        # At 3:10 the hours up to one are judged; c never loads, b has one row.
        assert run(("a", 0, 10), ("b", 0, 10), ("a", 3, 10)) == {"a": [1], "b": [1], "c": [0, 1]}
        # After a restart: only rows of others arrive, and the timers of b and c fire; d was not listed.
        assert run(("a", 5, 10), ("d", 5, 10)) == {"a": [1, 2], "b": [1, 2, 3], "c": [0, 1, 2, 3]}
        assert run(("b", 9, 0)) == {"a": [1, 2, 4, 6, 7], "b": [1, 2, 3, 4, 5, 6, 7], "c": [0, 1, 2, 3, 4, 5, 6, 7], "d": [6, 7]}
    finally:
        for name in alerts.STORE:
            spark.conf.unset(name)
