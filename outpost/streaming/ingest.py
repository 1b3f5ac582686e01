"""Ordered ingestion, each batch once.

A stream's micro-batches are written under their batch ids. A batch that is delivered again overwrites itself,
so that retries change nothing; reading checks that no batch is missing and gives rows in the order of batch
and row. Order within a batch is a column of the source, as Spark's partitions have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Partition column of the batches; no column of the source may have this name.
_BATCH = "outpost_batch"


class IncompleteStream(IOError):
    """Fewer batches than announced, or a gap between them."""


def write_batch(batch: DataFrame, number: int, path: str) -> None:
    """Write one batch under its number; again is the same as once."""
    batch.write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")


def ingest(stream: DataFrame, path: str, checkpoint: str):
    """Start a query that writes every micro-batch of ``stream`` under ``path``."""
    return stream.writeStream.foreachBatch(lambda df, i: write_batch(df, i, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_batches(spark: SparkSession, path: str, order: str | None = None, total: int | None = None, first: int = 0) -> DataFrame:
    """All rows, in order of batch, then ``order`` if one is asked for (a sort of all rows). total: announced
    number of batches, if any."""
    rows = spark.read.option("basePath", path).parquet(path)
    n, low, high = rows.agg(F.countDistinct(_BATCH), F.min(_BATCH), F.max(_BATCH)).first()
    want = total if total is not None else (high - first + 1 if n else 0)
    if n != want or (n and (low != first or high != first + n - 1)):
        raise IncompleteStream(f"stream ended with {n} of {want} batches received")
    return (rows.orderBy(_BATCH, order) if order else rows).drop(_BATCH)
