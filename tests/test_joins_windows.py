"""Helpers that must hold under skew, against plain joins and windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from tallywright.operators import joins, windows
from tallywright.session import settings


def skewed(spark, n=3000):
    rnd = random.Random(7)
    data = [("hot" if i % 3 == 0 else None if i % 50 == 0 else f"k{rnd.randrange(200)}", i) for i in range(n)]
    return spark.createDataFrame(data, "k string, v int").repartition(6)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_split_at_run_time(spark, rows, how):
    """Without broadcasts AQE deals the hot key's partition out to several tasks."""
    many = skewed(spark, 60_000)
    one = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 200, 2)], "k string, w int")
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    with settings(spark, forced):
        joined = joins.join_to_unique(many, one, "k", how).select("k", "v", "w")
        found = sorted(map(tuple, joined.collect()), key=repr)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert found == rows(many.join(one, "k", how), "k", "v", "w")
    assert "skew=true" in plan


@pytest.mark.parametrize("how", ["left", "full_outer"])
def test_outer_join_keeps_rows_without_key(spark, rows, how):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, r int")
    found = rows(joins.outer_join(left, right, "k", how), "k", "l", "r")
    assert found == rows(left.join(right, "k", how), "k", "l", "r")


def test_anti_join_keeps_rows_without_key(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.anti_join(left, right, "k")) == rows(left.join(right, "k", "left_anti"))


def test_keep_last_and_first(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "z")], "k string, seq int, t string")
    assert rows(windows.keep_last(df, "k", "seq")) == [("a", 2, None), ("b", 5, "z")]
    assert rows(windows.keep_first(df, "k", "seq")) == [("a", 1, "x"), ("b", 5, "z")]
    twice = windows.keep_last(windows.keep_last(df, "k", "seq"), "k", "seq")
    assert rows(twice) == rows(windows.keep_last(df, "k", "seq"))


def test_keep_last_with_missing_orders_and_keys(spark, rows):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 3, "z"), (None, 9, "p"), (None, 8, "q")], "k string, seq int, t string")
    assert rows(windows.keep_last(df, "k", "seq")) == [("a", None, "x"), ("b", 3, "z")]
    assert rows(windows.keep_first(df, "k", "seq")) == [("a", None, "x"), ("b", 3, "z")]


def test_previous_value_equals_lag(spark, rows):
    rnd = random.Random(3)
    data = [("s" if i % 3 else "t", i, rnd.randrange(90) if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(data, "k string, at int, n int").withColumn(
        "ts", F.timestamp_seconds(F.col("at") * 40_000)
    )
    plain = df.withColumn("prev", F.lag("n").over(Window.partitionBy("k").orderBy("ts")))
    bucketed = windows.previous_value(df, ["k"], "ts", "n", "prev", F.trunc("ts", "month"))
    assert rows(bucketed, "k", "ts", "n", "prev") == rows(plain, "k", "ts", "n", "prev")
