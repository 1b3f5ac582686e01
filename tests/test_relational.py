"""Relational queries on small tables of their own: what the given ones don't hold, and plans that hold at size."""

import pytest
from outpost.plans import registry
from pyspark.sql import functions as F


@pytest.fixture()
def given(spark, tmp_path):
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def plan(df):
    return df._jdf.queryExecution().toString()


def test_correlated_count(spark, given):
    nan = float("nan")
    customer = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, -1.0), (2, None), (None, 1.0), (3, 0.0), (4, nan), (5, -2.0)], "c_custkey long, c_acctbal double")
    orders = spark.createDataFrame([(1, 20.0), (1, 20.5), (1, None), (2, 9.0), (None, 90.0), (3, 0.0), (3, 1.0), (4, nan), (9, 1.0)], "o_custkey long, o_totalprice double")
    got = registry.queries()["b93_correlated_sum"](spark, given(customer=customer, orders=orders))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 1), (1, 1), (1, 2), (2, 0), (3, 1), (4, 0), (5, 0), (None, 0)]
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
