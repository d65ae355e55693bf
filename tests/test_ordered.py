"""Blocked windows equal ordinary ones, whatever the keys and the block size."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators.ordered import Blocks, Placed, split_hot
from carelake.plans.inventory import daily_inventory, moving_cost, stock_windows
from carelake.plans.mart import next_in_group, readmission_rates
from carelake.plans.patients import patient_acuity, patient_journey, patient_journey_plain
from carelake.registry.aggregates import labelled
from conftest import rows

SCHEMA = """event_id string, patient_id string, event_time timestamp_ntz, event_type string, event_category string,
    amount decimal(38,2), provider_id string, department_id string"""


def events(spark, seed, n=120):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        # A third belongs to one patient, some to nobody; times repeat or are missing.
        patient = rng.choice(["hot", "hot", None, "p1", "p2", f"q{i}"])
        when = rng.choice([None, dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(70), hours=rng.randrange(3))])
        amount = rng.choice([None, rng.randrange(1000)])
        kind = rng.choice(["appointment", "encounter", "payment"])
        data.append((f"e{i:03}", patient, when, kind, "OTHER", amount, "d", "w"))
    df = spark.createDataFrame(data, SCHEMA.replace("decimal(38,2)", "int"))
    return df.withColumn("amount", F.col("amount").cast("decimal(38,2)"))


@pytest.mark.parametrize("seed, hot_rows, block_rows", [(1, 0, 3), (2, 0, 7), (3, 10, 5), (4, 0, 1000), (5, 10**6, None)])
def test_journey_equals_plain_windows(spark, seed, hot_rows, block_rows):
    df = events(spark, seed)
    expected = patient_journey_plain(df)
    got = patient_journey(df, hot_rows, block_rows)
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got, *sorted(got.columns)) == rows(expected, *sorted(got.columns))


def test_journey_of_nothing(spark):
    assert patient_journey(events(spark, 1).filter("event_id = ''")).count() == 0


def test_split_hot(spark):
    df = events(spark, 1)
    cold, hot = split_hot(df, ["patient_id"], 15)
    assert hot is not None and cold.count() + hot.count() == df.count()
    assert {r[0] for r in hot.select("patient_id").distinct().collect()} <= {"hot", None, "p1", "p2"}
    same, none = split_hot(df, ["patient_id"], 10**6)
    assert none is None and same is df


def test_next_in_group(spark):
    df = events(spark, 6).select("event_id", "patient_id", "event_time")
    plain = next_in_group(df, "patient_id", ["event_time", "event_id"], {"n": "event_time"})
    blocked = next_in_group(df, "patient_id", ["event_time", "event_id"], {"n": "event_time"}, hot_rows=0, block_rows=4)
    assert rows(plain) == rows(blocked)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 23])
def test_ntile_equals_window(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 11).alias("score"), "id")
    placed = Placed(df, [F.col("score").desc_nulls_first(), F.col("id")])
    got = placed.rows.select("id", placed.ntile(5).alias("t"))
    w = Window.orderBy(F.col("score").desc_nulls_first(), "id")
    assert rows(got) == rows(df.select("id", F.ntile(5).over(w).cast("bigint").alias("t")))


def test_prefix_sums(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).alias("v"))
    placed = Placed(df, [F.col("id")], {"v_sum": F.col("v")})
    got = {r["id"]: r["v_sum_before"] for r in placed.prefix_sums().collect()}
    assert got == {i: sum(j % 3 for j in range(i)) for i in range(50)}
    assert placed.totals["v_sum"] == sum(j % 3 for j in range(50))


def test_frame_wider_than_block(spark):
    blocks = Blocks(spark.range(5), [F.col("id")], block_rows=2)
    with pytest.raises(ValueError):
        blocks.near(blocks.rows, [], {"x": lambda w: F.lag("id", 3).over(w)}, before=3)


def test_moving_cost_of_hot_products(spark, inputs):
    daily = daily_inventory(inputs("fx_stock_movements"))
    columns = ["movement_date", "facility_id", "product_id", F.round("moving_avg_cost", 6)]
    assert rows(moving_cost(daily, hot_rows=30, block_rows=11), *columns) == rows(moving_cost(daily), *columns)


def test_readmissions_of_hot_patients(spark, inputs):
    facts = inputs("fx_facts")
    args = (facts, "1996-01-01", "1999-12-31")
    assert rows(readmission_rates(*args, hot_rows=2)) == rows(readmission_rates(*args))


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))


def test_no_window_over_everything(spark, inputs):
    clean = labelled(inputs)
    acuity = patient_acuity(inputs("fx_encounters"), inputs("fx_diagnoses"), clean)
    for df in (acuity, patient_journey(clean)):
        assert "SinglePartition" not in _plan(df)
    assert "SinglePartition" in _plan(patient_journey_plain(clean))


def test_stock_windows_of_hot_keys(spark, inputs):
    movements = inputs("fx_stock_movements")
    # A product without an id gathers the names of its facility; some days have no quantity.
    gone = F.col("product_id").cast("int") % 3 == 0
    movements = movements.withColumn("product_id", F.when(~gone, F.col("product_id"))).withColumn(
        "quantity", F.when(F.col("product_id").cast("int") % 7 != 1, F.col("quantity"))
    ).withColumn("movement_date", F.when(F.dayofmonth("movement_date") != 9, F.col("movement_date")))
    daily = daily_inventory(movements)
    plain = stock_windows(daily)
    assert rows(stock_windows(daily, hot_rows=20, block_rows=31)) == rows(plain)
    assert plain.filter("product_id is null").count() > 500
