"""Upserts, replacement and history."""

import datetime as dt
from random import Random

import pytest
from pyspark.sql import functions as F

from carelake.operators.bitmaps import DistinctStore, bitmaps, distinct_counts
from carelake.operators.dedup import first_per_key, has_id, latest_per_key
from carelake.operators.merge import DuplicateKeys, merge_upsert
from carelake.operators.scd2 import scd2_apply
from carelake.plans.clean import MERGE_KEYS, clean_source, empty_clean, flat_source, merge_clean
from carelake.plans.products import merge_daily
from conftest import rows

SCHEMA = "k string, v int, at int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_merge_updates_and_inserts(spark):
    out = merge_upsert(frame(spark, ("a", 1, 1), ("b", 2, 1)), frame(spark, ("b", 20, 2), ("c", 30, 2)), ["k"], ["v"])
    assert rows(out) == [("a", 1, 1), ("b", 20, 1), ("c", 30, 2)]


def test_null_keys_never_match(spark):
    out = merge_upsert(frame(spark, (None, 1, 1)), frame(spark, (None, 2, 2)), ["k"], ["v", "at"])
    assert rows(out) == [(None, 1, 1), (None, 2, 2)]


def test_guard_keeps_newer(spark):
    newer = lambda t, s: t("at") < s("at")
    out = merge_upsert(frame(spark, ("a", 1, 5), ("b", 1, 5)), frame(spark, ("a", 2, 4), ("b", 2, 6)), ["k"], ["v", "at"], when=newer)
    assert rows(out) == [("a", 1, 5), ("b", 2, 6)]


def test_null_guard_does_not_update(spark):
    newer = lambda t, s: t("at") < s("at")
    out = merge_upsert(frame(spark, ("a", 1, None)), frame(spark, ("a", 2, 4)), ["k"], ["v"], when=newer)
    assert rows(out) == [("a", 1, None)]


def test_update_to_null_and_duplicate_targets(spark):
    out = merge_upsert(frame(spark, ("a", 1, 1), ("a", 2, 2)), frame(spark, ("a", None, 9)), ["k"], ["v"])
    assert rows(out) == [("a", None, 1), ("a", None, 2)]


def test_merge_is_idempotent(spark):
    target, source = frame(spark, ("a", 1, 1)), frame(spark, ("a", 2, 2), ("b", 3, 3))
    once = merge_upsert(target, source, ["k"], ["v", "at"])
    assert rows(merge_upsert(once, source, ["k"], ["v", "at"])) == rows(once)


def test_insert_columns_and_stamps(spark):
    out = merge_upsert(
        frame(spark, ("a", 1, 1)), frame(spark, ("a", 2, 2), ("b", 3, 3)), ["k"], ["v"], insert_cols=["k"],
        on_update={"at": F.lit(100)}, on_insert={"at": F.lit(200)},
    )
    assert rows(out) == [("a", 2, 100), ("b", None, 200)]


def test_duplicate_source_keys_are_an_error(spark):
    with pytest.raises(DuplicateKeys):
        merge_upsert(frame(spark), frame(spark, ("a", 1, 1), ("a", 2, 2)), ["k"], ["v"], check_unique=True)
    merge_upsert(frame(spark), frame(spark, (None, 1, 1), (None, 2, 2)), ["k"], ["v"], check_unique=True)


def test_latest_and_first(spark):
    df = frame(spark, ("a", 1, 1), ("a", 2, 2), ("a", 3, 2), ("b", 9, None))
    assert rows(latest_per_key(df, ["k"], "at", ["v"])) == [("a", 3, 2), ("b", 9, None)]
    assert rows(first_per_key(df, ["k"], [F.col("at").asc(), F.col("v").asc()])) == [("a", 1, 1), ("b", 9, None)]


def test_latest_is_limited_before_the_shuffle(spark):
    plan = latest_per_key(frame(spark, ("a", 1, 1)), ["k"], "at", ["v"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_has_id(spark):
    df = spark.createDataFrame([(None, None), (" ", None), (None, "u"), ("1", None)], "id string, uuid string")
    assert has_id(df, "either").count() == 3
    assert has_id(df, "non_blank").count() == 1


def raw(spark, *lines):
    df = spark.createDataFrame([(f, dt.datetime(2024, 1, d), j) for f, d, j in lines], "facility_id string, ingested_at timestamp_ntz, j string")
    return df.select("facility_id", F.lit("t").alias("source_table"), "ingested_at", F.parse_json("j").alias("payload"), F.md5("j").alias("row_hash"))


def test_clean_keeps_newest_and_ignores_late(spark):
    first = raw(spark, ("f", 2, '{"id":"1","amount":"5","event_time":"2024-01-01 10:00:00","type":"payment"}'), ("f", 2, '{"x":1}'))
    late = raw(spark, ("f", 1, '{"id":"1","amount":"7"}'), ("g", 1, '{"uuid":"1","currency":"USD"}'))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    stored = merge_clean(empty_clean(spark), clean_source(first), now)
    got = {(r.facility_id, r.event_id): r for r in merge_clean(stored, clean_source(late), now).collect()}
    assert set(got) == {("f", "1"), ("g", "1")}
    assert str(got["f", "1"].amount) == "5.00" and got["f", "1"].event_category == "FINANCIAL"
    assert got["g", "1"].currency == "USD" and got["g", "1"].validation_status == "MISSING_AMOUNT"
    assert got["f", "1"].currency == "KES" and got["f", "1"].is_duplicate is False
    assert MERGE_KEYS == ["event_id", "facility_id"]


def test_flat_lines(spark):
    lines = raw(spark, ("f", 1, '[{"id":"1","amount":"2"},{"id":" "},{"no":1}]'), ("f", 2, '{"id":"1","amount":"3"}'), ("f", 1, '{"token":"t"}'))
    assert [(r.event_id, str(r.amount)) for r in flat_source(lines).collect()] == [("1", "3.00")]
    half = raw(spark, ("f", 1, '{"id":"1","amount":"2.5"}'), ("f", 1, '{"id":"2","amount":3.5}'))
    assert sorted(str(r.amount) for r in flat_source(half, strict_numbers=True).collect()) == ["3", "4"]


def test_daily_merge(spark):
    schema = "product_name string, scrape_date timestamp_ntz, url string, current_price double"
    day1, later, day2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 18), dt.datetime(2024, 1, 2, 8)
    target = spark.createDataFrame([("p", day1, "u", 1.0)], schema)
    scrapes = spark.createDataFrame([("p", day1, "u", 1.0), ("p", later, "u", 2.0), ("p", day2, "u", 3.0), (None, day2, "u", 4.0)], schema)
    out = merge_daily(target, scrapes)
    assert rows(out) == sorted([("p", day1, "u", 2.0), ("p", day2, "u", 3.0), (None, day2, "u", 4.0)], key=repr)


def test_scd2(spark):
    old, new = dt.date(2020, 1, 1), dt.date(2024, 1, 31)
    dim = spark.createDataFrame(
        [("a", "x", "keep", old, None, True), ("b", "y", "keep", old, None, True), ("a", "w", "keep", dt.date(2019, 1, 1), old, False)],
        "id string, name string, extra string, effective_date date, end_date date, is_current boolean",
    )
    changes = spark.createDataFrame([("a", "x2"), ("b", "y"), ("c", None), (None, "n")], "id string, name string")
    out = scd2_apply(dim, changes, "id", ["name"], "2024-01-31")
    assert rows(out) == sorted(
        [("a", "w", "keep", dt.date(2019, 1, 1), old, False), ("a", "x", "keep", old, new, False), ("a", "x2", "keep", new, None, True),
         ("b", "y", "keep", old, None, True), ("c", None, None, new, None, True), (None, "n", None, new, None, True)], key=repr)
    again = scd2_apply(out, changes.filter("id is not null"), "id", ["name"], "2024-02-01")
    assert rows(again) == rows(out)


def test_uniqueness_is_checked_unless_waived(spark):
    twice = frame(spark, ("a", 1, 1), ("a", 1, 1), ("c", 2, 2), ("c", 3, 3))
    with pytest.raises(DuplicateKeys):
        merge_upsert(frame(spark, ("a", 0, 0), ("b", 0, 0)), twice, ["k"], ["v"])
    history = spark.createDataFrame([], "k string, v int, effective_date date, end_date date, is_current boolean")
    with pytest.raises(DuplicateKeys):
        scd2_apply(history, twice.select("k", "v"), "k", ["v"], "2024-01-01")


def test_clean_and_merge_take_the_same_keys(spark):
    raw = spark.createDataFrame(
        [("f", dt.datetime(2024, 1, 2), "h1", "a", '{"id":"1","type":"x"}'), ("f", dt.datetime(2024, 1, 2), "h2", "b", '{"id":"1","type":"y"}')],
        "facility_id string, ingested_at timestamp_ntz, row_hash string, source_table string, payload string",
    ).withColumn("payload", F.parse_json("payload"))
    keys = [*MERGE_KEYS, "source_table"]
    source = clean_source(raw, keys=keys)
    assert source.count() == 2
    empty = empty_clean(spark).withColumn("source_table", F.lit(None).cast("string"))
    now = F.lit("2024-01-03").cast("timestamp_ntz")
    stored = merge_clean(empty, source, now, keys)
    again = merge_clean(stored, source.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")), now, keys)
    assert rows(again, "event_id", "source_table", "event_type") == [("1", "a", "x"), ("1", "b", "y")]


def test_offsets_fix_the_instant(spark):
    raw = spark.createDataFrame(
        [("f", dt.datetime(2024, 1, 2), "h1", "a", '{"id":"1","event_time":"2024-01-01T00:30:00+03:00"}'), ("f", dt.datetime(2024, 1, 2), "h2", "b", '{"id":"2","event_time":"2024-01-01 00:30:00"}')],
        "facility_id string, ingested_at timestamp_ntz, row_hash string, source_table string, payload string",
    ).withColumn("payload", F.parse_json("payload"))
    for cleaned in (clean_source(raw), flat_source(raw)):
        assert rows(cleaned, "event_id", "event_time") == [("1", dt.datetime(2023, 12, 31, 21, 30)), ("2", dt.datetime(2024, 1, 1, 0, 30))]


def test_history_with_deliveries_in_any_order(spark):
    """Against a list of intervals per key, spliced one by one."""
    some, day = Random(5), lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    empty = spark.createDataFrame([], "k string, v string, effective_date date, end_date date, is_current boolean")
    history, want = empty, {k: [] for k in "abcdef"}
    for _ in range(7):
        at = day(some.randrange(12))
        delivery = {k: some.choice("xyz") for k in want if some.random() < 0.6}
        for k, v in delivery.items():
            held = next((i for i in want[k] if i[0] <= at and (i[1] is None or at < i[1])), None)
            if held is None:
                want[k].append([at, min((i[0] for i in want[k] if i[0] > at), default=None), v])
            elif held[2] != v:
                want[k].append([at, held[1], v])
                held[1] = at
                if held[0] == at:
                    want[k].remove(held)
        changes = spark.createDataFrame(list(delivery.items()), "k string, v string")
        history = spark.createDataFrame(scd2_apply(history, changes, "k", ["v"], at).collect(), empty.schema)
    got = sorted((r.k, r.effective_date, r.end_date, r.v, r.is_current) for r in history.collect())
    assert got == sorted((k, a, b, v, b is None) for k, found in want.items() for a, b, v in found)
    for k in want:
        times = [(a, b or dt.date.max) for key, a, b, *_ in got if key == k]
        assert all(a < b for a, b in times) and all(x[1] <= y[0] for x, y in zip(times, times[1:]))


def test_bitmaps_add_up(spark):
    rows = spark.range(60_000).selectExpr("id % 30 as day", "if(id % 3 = 0, 'hot', 'f' || id % 5) as f", "case when id % 11 = 0 then null else 'v' || (id * 7919) % 40000 end as v")
    store = DistinctStore(["day", "f"], "v")
    halves = [rows.where("day < 18"), rows.where("day > 11"), rows.where("day < 18")]
    for part in halves:
        stored = store.load(part)
    assert store.numbers.count() == store.numbers.select("number").distinct().count() == rows.select("v").distinct().count() - 1
    for keys, sql in ((["day", "f"], "day, f"), ([F.floor(F.col("day") / 7).alias("week"), "f"], "floor(day / 7), f"), (["f"], "f")):
        got = sorted(tuple(r) for r in distinct_counts(stored, keys).collect())
        want = rows.groupBy(*keys).agg(F.countDistinct("v").alias("n")).where("n > 0")
        assert got == sorted(tuple(r) for r in want.collect()), sql
    assert "Expand" not in distinct_counts(stored, ["f"])._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="has no number"):
        bitmaps(rows, ["f"], "v", store.numbers.where("number > 5")).collect()
