"""All queries of the library outside ``outpost.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outpost.plans import changes, relational

_MODULES = (relational, changes)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in _MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.oracle_sql().items()}
