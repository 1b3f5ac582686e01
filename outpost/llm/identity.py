"""Rows known by their id and what they hold, so that decisions find their way back to them.

A null id or text is a value like any other here, and the row itself is one column, so that no name of its
columns can clash with those that decisions add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Columns that ``identified`` adds beside ``row``.
KEYS = ["id", "hash"]


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))


def row_hash(*columns: str) -> Column:
    """Hash of the named columns, and of whether they or the id are null."""
    nulls = [F.col(c).isNull() for c in ("doc_id", *columns)]
    return F.xxhash64(*nulls, *columns)


def identified(docs: DataFrame, *columns: str) -> DataFrame:
    """``id, hash, row``: equal ``id`` and ``hash`` for rows with an equal ``doc_id`` and equal ``columns``."""
    return docs.select(row_id().alias("id"), row_hash(*columns).alias("hash"), F.struct(*docs.columns).alias("row"))
