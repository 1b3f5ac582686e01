"""Session settings that the library relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "outpost", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` overrides (dots written as two underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def tagged(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs started inside carry a tag, by which ``cancel`` finds them from another thread."""
    spark.sparkContext.addJobTag(name)
    try:
        yield
    finally:
        spark.sparkContext.removeJobTag(name)


def cancel(spark: SparkSession, name: str) -> None:
    """Cancel what runs under a tag, from any thread; without such jobs nothing happens."""
    spark.sparkContext.cancelJobsWithTag(name)
