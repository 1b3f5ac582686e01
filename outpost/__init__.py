"""Outpost: attachable Parquet namespaces, relational queries and change operators on Spark."""

from outpost.session import build_session

__all__ = ["build_session"]
