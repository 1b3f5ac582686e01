"""Reading tables and attaching namespaces."""

from outpost.sources.tables import TABLES, read_table

__all__ = ["TABLES", "read_table"]
