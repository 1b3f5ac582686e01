"""The driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; the path may be in any store that Spark reads."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
