"""Attachable namespaces: folders of Parquet tables under nested schemas.

A namespace is a folder in any store that Spark reads; a schema is a sub-folder, a table a Parquet folder or
file, a view a file that holds its SQL. Attaching names it; tables are then DataFrames and temporary views, so
that queries over several namespaces and local tables are one Catalyst plan.

A new table, or a change of one, is written to a folder beside it and takes its place by renames. If the second
of them fails, the first is taken back. Between the two a reader may find no table; readers that have
listed the old files lose them when the change is published, as with any Parquet folder. A change to a table that
someone else has published since this namespace read it is an error, not a lost update.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from outpost.operators.change import Change, Constraints

_TABLE, _VIEW = ".parquet", ".view"


class CatalogError(LookupError):
    """A name that isn't there, or is there already."""


class Namespace:
    def __init__(self, spark: SparkSession, path: str, alias: str, read_only: bool = False):
        self.spark, self.root, self.alias, self.read_only = spark, path.rstrip("/"), alias, read_only
        self._seen: dict[str, int] = {}
        fs, Path = self._fs()
        if not fs.exists(Path(self.root)):
            if read_only:
                raise CatalogError(f'"{path}" does not exist')
            fs.mkdirs(Path(self.root))

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _writable(self):
        if self.read_only:
            raise CatalogError(f'"{self.alias}" is attached read-only')
        return self._fs()

    def _entries(self, at: str) -> list[str]:
        fs, Path = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(Path(at))] if fs.exists(Path(at)) else []
        return sorted(n for n in names if not n.startswith((".", "_")))

    def _parts(self, name: str) -> list[str]:
        parts = name.split(".")
        return parts[1:] if len(parts) > 1 and parts[0].casefold() == self.alias.casefold() else parts

    def _find(self, name: str, endings: Sequence[str]) -> str | None:
        """Path of ``[alias.][schema.…]name`` if it is there, with one of the endings ("" for a schema). Names
        compare without case; one that is written just so goes first."""
        at, parts = self.root, self._parts(name)
        for k, p in enumerate(parts):
            ends = endings if k == len(parts) - 1 else ("",)
            match = [e for e in self._entries(at) for end in ends if (e.endswith(end) if end else not e.endswith((_TABLE, _VIEW))) and e.removesuffix(end).casefold() == p.casefold()]
            if not match:
                return None
            at = f"{at}/{min(match, key=lambda e: (e.split('.')[0] != p, e))}"
        return at

    def _new(self, name: str, ending: str) -> str:
        """Where a name is to be made; parts that are there already keep their spelling."""
        at, parts = self.root, self._parts(name)
        for k in range(1, len(parts)):
            at = self._find(".".join(parts[:k]), ("",)) or f"{at}/{parts[k - 1]}"
        return f"{at}/{parts[-1]}{ending}"

    def _path(self, name: str) -> str:
        at = self._find(name, (_TABLE,))
        if at is None:
            raise CatalogError(f'Table with name "{name}" does not exist in "{self.alias}"')
        return at

    def _stamp(self, at: str) -> int:
        fs, Path = self._fs()
        return fs.getFileStatus(Path(at)).getModificationTime()

    def table(self, name: str) -> DataFrame:
        """A table, or what a stored view gives now."""
        return self._read(name, ())

    def _read(self, name: str, inside: tuple[str, ...]) -> DataFrame:
        view = self._find(name, (_VIEW,))
        if view is None:
            at = self._path(name)
            self._seen.setdefault(at, self._stamp(at))
            return self.spark.read.parquet(at)
        if view in inside:
            raise CatalogError(f'View "{name}" refers to itself')
        text = "\n".join(r.value for r in self.spark.read.text(view, wholetext=True).collect())
        used = list(dict.fromkeys(re.findall(r"\{([\w.]+)\}", text)))
        bound = {f"__t{i}": self._read(n, (*inside, view)) for i, n in enumerate(used)}
        for i, n in enumerate(used):
            text = text.replace("{" + n + "}", "{" + f"__t{i}" + "}")
        return self.spark.sql(text, **bound)

    def _walk(self, ending: str) -> list[tuple[str, str]]:
        rows, todo = [], [(self.root, "")]
        while todo:
            at, schema = todo.pop()
            for name in self._entries(at):
                if name.endswith(ending):
                    rows.append((schema, name.removesuffix(ending)))
                elif not name.endswith((_TABLE, _VIEW)):
                    todo.append((f"{at}/{name}", f"{schema}.{name}" if schema else name))
        return sorted(rows)

    def tables(self) -> DataFrame:
        """``schema_name, table_name`` of all tables, schemas as dotted paths."""
        return self.spark.createDataFrame(self._walk(_TABLE), "schema_name string, table_name string")

    def views(self) -> DataFrame:
        return self.spark.createDataFrame(self._walk(_VIEW), "schema_name string, view_name string")

    def columns(self) -> DataFrame:
        """``schema_name, table_name, column_name, place, kind`` of all tables' columns, from their footers."""
        rows = []
        for schema, name in self._walk(_TABLE):
            found = self.spark.read.parquet(self._path(".".join(x for x in (schema, name) if x))).dtypes
            rows += [(schema, name, c, i, kind) for i, (c, kind) in enumerate(found)]
        return self.spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, place int, kind string")

    def register_views(self) -> list[str]:
        """Make every table a temporary view named alias_schema_table."""
        names = []
        for r in self.tables().collect():
            dotted = ".".join(x for x in (r.schema_name, r.table_name) if x)
            names.append("_".join([self.alias, *dotted.split(".")]))
            self.table(dotted).createOrReplaceTempView(names[-1])
        return names

    def create(self, name: str, rows: DataFrame, replace: bool = False, if_not_exists: bool = False) -> None:
        """CREATE TABLE … AS; the parts of a dotted name before the last are made as schemas."""
        self._writable()
        if self._find(name, (_VIEW,)):
            raise CatalogError(f'"{name}" is a view')
        at = self._find(name, (_TABLE,))
        if at and not replace:
            if if_not_exists:
                return
            raise CatalogError(f'Table with name "{name}" already exists')
        self._publish(at or self._new(name, _TABLE), rows)

    def create_view(self, name: str, sql: str, replace: bool = False, if_not_exists: bool = False) -> None:
        """Store a view: SQL with the namespace's own tables and views in braces, read anew at each use."""
        fs, Path = self._writable()
        if self._find(name, (_TABLE,)):
            raise CatalogError(f'"{name}" is a table')
        at = self._find(name, (_VIEW,))
        if at and not replace:
            if if_not_exists:
                return
            raise CatalogError(f'View with name "{name}" already exists')
        out = fs.create(Path(at or self._new(name, _VIEW)), True)
        try:
            out.write(bytearray(sql.encode()))
        finally:
            out.close()

    def create_schema(self, name: str, if_not_exists: bool = False) -> None:
        """CREATE SCHEMA; the schemas that it lies in must be there."""
        fs, Path = self._writable()
        parts = self._parts(name)
        if self._find(name, ("",)):
            if if_not_exists:
                return
            raise CatalogError(f'Schema with name "{name}" already exists')
        if len(parts) > 1 and not self._find(".".join(parts[:-1]), ("",)):
            raise CatalogError(f'Schema with name "{".".join(parts[:-1])}" does not exist')
        fs.mkdirs(Path(self._new(name, "")))

    def drop_schema(self, name: str, cascade: bool = False, if_exists: bool = False) -> None:
        """DROP SCHEMA; one that holds anything goes only with ``cascade``."""
        fs, Path = self._writable()
        at = self._find(name, ("",))
        if at is None:
            if if_exists:
                return
            raise CatalogError(f'Schema with name "{name}" does not exist')
        if self._entries(at) and not cascade:
            raise CatalogError(f'Schema "{name}" is not empty')
        fs.delete(Path(at), True)

    def apply(self, name: str, change: Change, constraints: Constraints | None = None) -> int:
        """Make a change the table's rows, if the constraints hold; returns how many rows it touched."""
        self._writable()
        at = self._path(name)
        if self._seen.get(at, self._stamp(at)) != self._stamp(at):
            raise CatalogError(f'Table with name "{name}" was changed by someone else since it was read')
        touched = change.touched.count()
        self._publish(at, change.after, constraints)
        return touched

    def alter(self, name: str, **how) -> None:
        """ALTER TABLE: see ``altered``."""
        self._writable()
        self._publish(self._path(name), altered(self.table(name), **how))

    def rename(self, name: str, new: str) -> None:
        """Give a table another name in its schema."""
        fs, Path = self._writable()
        old = self._path(name)
        schema = ".".join(self._parts(name)[:-1])
        taken = self._find(f"{schema}.{new}" if schema else new, (_TABLE, _VIEW))
        if taken and taken != old:
            raise CatalogError(f'Table with name "{new}" already exists')
        if not fs.rename(Path(old), Path(f"{old.rsplit('/', 1)[0]}/{new}{_TABLE}")):
            raise OSError(f"could not rename {old}")
        self._seen.pop(old, None)

    def drop(self, name: str, if_exists: bool = False) -> None:
        """DROP TABLE or VIEW; a schema isn't one."""
        fs, Path = self._writable()
        at = self._find(name, (_TABLE, _VIEW))
        if at is None:
            if if_exists:
                return
            raise CatalogError(f'Table with name "{name}" does not exist in "{self.alias}"')
        fs.delete(Path(at), True)
        self._seen.pop(at, None)

    def _publish(self, at: str, rows: DataFrame, constraints: Constraints | None = None) -> None:
        fs, Path = self._fs()
        folder, name = at.rsplit("/", 1)
        new, old = f"{folder}/.new-{name}-{uuid.uuid4().hex}", f"{folder}/.old-{name}-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(new)
            if constraints:
                constraints.verify(self.spark.read.schema(rows.schema).parquet(new))
            if fs.exists(Path(at)) and not fs.rename(Path(at), Path(old)):
                raise OSError(f"could not publish {at}")
            if not fs.rename(Path(new), Path(at)):
                if fs.exists(Path(old)):
                    fs.rename(Path(old), Path(at))
                raise OSError(f"could not publish {at}")
        except Exception:
            fs.delete(Path(new), True)
            raise
        if fs.exists(Path(old)):
            fs.delete(Path(old), True)
        self._seen[at] = self._stamp(at)
        self.spark.catalog.refreshByPath(at)


def lookup(spark: SparkSession, name: str, attached: Sequence[Namespace], path: Sequence[str] = ()) -> DataFrame:
    """A name as a statement would find it: a temporary view first, then the namespaces and schemas of the
    search ``path`` (``alias`` or ``alias.schema``) in their order, then a name that starts with an alias."""
    if "." not in name and spark.catalog.tableExists(name):
        return spark.table(name)
    known = {n.alias.casefold(): n for n in attached}
    for at in path:
        alias, _, schema = at.partition(".")
        if alias.casefold() not in known:
            raise CatalogError(f'"{alias}" is not attached')
        # below the namespace, so that an alias at the head of the name isn't dropped
        whole = ".".join(x for x in (alias, schema, name) if x)
        if known[alias.casefold()]._find(whole, (_TABLE, _VIEW)):
            return known[alias.casefold()].table(whole)
    alias = name.split(".")[0].casefold()
    if "." in name and alias in known:
        return known[alias].table(name)
    raise CatalogError(f'Table with name "{name}" does not exist')


def altered(rows: DataFrame, add: Mapping[str, Column] | None = None, rename: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """``rows`` with columns dropped, renamed, then added with a default; ``struct.field`` adds a nested field.
    A column that is missing, or there already, is an error. Names compare without case."""
    known = lambda c: c.casefold() in {x.casefold() for x in rows.columns}
    for c in (*drop, *(rename or {}), *[a.split(".")[0] for a in add or {} if "." in a]):
        if not known(c):
            raise CatalogError(f'Column with name "{c}" does not exist')
    rows = rows.drop(*drop)
    for old, new in (rename or {}).items():
        if known(new) and new.casefold() != old.casefold():
            raise CatalogError(f'Column with name "{new}" already exists')
        rows = rows.withColumnRenamed(old, new)
    for name, value in (add or {}).items():
        top, _, field = name.partition(".")
        if not field and known(name):
            raise CatalogError(f'Column with name "{name}" already exists')
        rows = rows.withColumn(top, F.col(top).withField(field, value) if field else value)
    return rows


def attach(spark: SparkSession, path: str, alias: str, read_only: bool = False) -> Namespace:
    """Name a folder of tables; one that isn't there is made, unless it is attached read-only."""
    return Namespace(spark, path, alias, read_only)
