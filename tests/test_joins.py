"""Joins against plain ones, on keys that hold a third of all rows, none, or nulls."""

import pytest
from outpost.operators import joins
from pyspark.sql import functions as F


def values(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def hot(spark):
    return spark.range(3000).select((F.col("id") % 3 * F.col("id")).alias("k"), F.col("id").alias("v")).withColumn("k", F.when(F.col("v") != 7, F.col("k")))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, hot, how):
    right = spark.range(0, 4000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    right = right.unionByName(right.where("k = 0"))
    assert values(joins.salted_join(hot, right, ["k"], ["v"], joins.hot_keys(hot, ["k"]), how)) == values(hot.join(right, ["k"], how))
    assert [tuple(r) for r in joins.hot_keys(hot, ["k"]).collect()] == [(0, 2)]
    assert joins.hot_keys(hot.limit(0), ["k"]) is None
    assert values(joins.salted_join(hot.limit(5), right, ["k"], ["v"], None, how)) == values(hot.limit(5).join(right, ["k"], how))


def test_salted_join_spreads(spark, hot):
    right = spark.createDataFrame([(0, 1)], "k long, w int")
    keys = joins.hot_keys(hot, ["k"], rows=100)
    assert [tuple(r) for r in keys.collect()] == [(0, 10)]
    assert joins.salted_join(hot, right, ["k"], ["v"], keys).count() == 1000


def test_paired(spark, hot):
    n = hot.groupBy("k").agg(F.count(F.lit(1)).alias("many"))
    side = hot.where("v < 900").join(n, "k")
    x, y = side.withColumnRenamed("v", "vx"), side.withColumnRenamed("v", "vy")
    want = x.drop("many").join(y.drop("many"), "k")
    got = joins.paired(x, y, "k", "many", ("vx", "vy"), rows=40)
    assert got.columns == want.columns and values(got) == values(want)


def test_broadcast_is_measured_in_bytes(spark, monkeypatch):
    wide = spark.createDataFrame([(1, "x" * 3000), (2, None)], "k int, t string")
    df = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert "Broadcast" in joins.lookup_join(df, wide, ["k"])._jdf.queryExecution().simpleString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert not joins._small(wide, 10) and joins._small(df, 10) and not joins._small(df, 2)
    assert values(joins.lookup_join(df, wide, ["k"], "left")) == values(df.join(wide, "k", "left"))
