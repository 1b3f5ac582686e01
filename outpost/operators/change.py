"""INSERT, UPDATE, DELETE, MERGE and upsert as DataFrame transformations.

Each returns a ``Change``: the table's rows after the statement and the rows that it touched, from which
RETURNING lists and row counts are selected. Nothing runs until one of them is used. Conditions that are null
touch nothing. Keys are compared with ``=``, so a null key matches nothing: such a source row is new, such a
target row has no match. Joins are left to Catalyst; only keys are shuffled where neither side is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

_TARGET, _SOURCE = "__in_target", "__in_source"


class ChangeError(ValueError):
    """A statement that has no defined result."""


@dataclass(frozen=True)
class Change:
    """``after``: the table; ``touched``: rows inserted or updated as they are now, rows deleted as they were."""

    after: DataFrame
    touched: DataFrame

    def returning(self, *columns: str | Column) -> DataFrame:
        return self.touched.select(*(columns or ("*",)))

    def count(self) -> DataFrame:
        return self.touched.agg(F.count(F.lit(1)).alias("count"))


def _hit(where: Column | None) -> Column:
    return F.lit(True) if where is None else F.coalesce(where, F.lit(False))


def insert(table: DataFrame, rows: DataFrame, columns: Sequence[str] | None = None, defaults: Mapping[str, Column] | None = None) -> Change:
    """Append ``rows``, by position to ``columns`` (all columns if None); others take their default or null."""
    names = list(columns or table.columns)
    if len(rows.columns) != len(names):
        raise ChangeError(f"{len(names)} columns but {len(rows.columns)} values")
    unknown = [c for c in names if c not in table.columns]
    if unknown:
        raise ChangeError(f"no such columns: {unknown}")
    given, defaults = rows.toDF(*names), defaults or {}
    new = given.select(*[(F.col(c) if c in names else defaults.get(c, F.lit(None))).cast(table.schema[c].dataType).alias(c) for c in table.columns])
    return Change(table.unionByName(new), new)


def update(table: DataFrame, values: Mapping[str, Column], where: Column | None = None) -> Change:
    hit = _hit(where)
    new = {c: values[c].cast(table.schema[c].dataType) for c in values}
    after = table.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in table.columns])
    touched = table.where(hit).select(*[new.get(c, F.col(c)).alias(c) for c in table.columns])
    return Change(after, touched)


def delete(table: DataFrame, where: Column | None = None) -> Change:
    return Change(table.where(~_hit(where)), table.where(_hit(where)))


def delete_using(table: DataFrame, using: DataFrame, on: Sequence[str] | Column) -> Change:
    """Rows with a match in ``using`` go, however many matches they have."""
    on = list(on) if not isinstance(on, Column) else on
    return Change(table.join(using, on, "left_anti"), table.join(using, on, "left_semi"))


def require_unique(rows: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a key occurs twice (stops at the first that does)."""
    again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if again:
        raise ChangeError(f"{what}: key {tuple(again[0])[:-1]} occurs more than once")


def _sided(table: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Both sides joined by ``keys``; the source's columns as ``s.<name>`` through the struct column ``s``."""
    t = table.withColumn(_TARGET, F.lit(True))
    s = source.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*source.columns).alias("s"), F.lit(True).alias(_SOURCE))
    on = [t[k] == s[f"__k{i}"] for i, k in enumerate(keys)]
    return t.join(s, on, how)


def update_from(table: DataFrame, source: DataFrame, keys: Sequence[str], values: Mapping[str, Column], where: Column | None = None) -> Change:
    """Update rows that match ``source`` by ``keys``; ``values`` and ``where`` may use ``s.<column>``. A row
    that would match two source rows has no defined result, so that the source's keys must differ."""
    require_unique(source.select(*keys).join(table.select(*keys).distinct(), list(keys), "left_semi"), keys, "UPDATE FROM")
    j = _sided(table, source, keys, "left")
    hit = F.col(_SOURCE).isNotNull() & _hit(where)
    new = {c: values[c].cast(table.schema[c].dataType) for c in values}
    after = j.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in table.columns])
    return Change(after, j.where(hit).select(*[new.get(c, F.col(c)).alias(c) for c in table.columns]))


def update_where(table: DataFrame, source: DataFrame, on: Column, values: Mapping[str, Column], keys: Sequence[str]) -> Change:
    """UPDATE … FROM with any predicate: rows of ``table`` (known by ``keys``, which must be unique) that meet a row
    of ``source``, which may be a join itself, take ``values``. One that meets several rows is an error."""
    names = {c: f"__new_{c}" for c in values}
    met = table.join(source, on).select(*[table[k] for k in keys], *[values[c].cast(table.schema[c].dataType).alias(n) for c, n in names.items()])
    require_unique(met, keys, "UPDATE FROM")
    j = table.join(met.withColumn(_SOURCE, F.lit(True)), list(keys), "left")
    hit = F.col(_SOURCE).isNotNull()
    new = lambda c: F.col(names[c]) if c in names else F.col(c)
    after = j.select(*[F.when(hit, new(c)).otherwise(F.col(c)).alias(c) for c in table.columns])
    return Change(after, j.where(hit).select(*[new(c).alias(c) for c in table.columns]))


@dataclass(frozen=True)
class When:
    """A clause of MERGE. ``kind``: ``matched``, ``not matched`` or ``not matched by source``; ``do``:
    ``update``, ``delete``, ``insert`` or ``nothing``; conditions and values may use ``s.<column>``."""

    kind: str
    do: str
    values: Mapping[str, Column] = field(default_factory=dict)
    condition: Column | None = None


_ALLOWED = {"matched": {"update", "delete", "nothing"}, "not matched": {"insert", "nothing"}, "not matched by source": {"update", "delete", "nothing"}}


def merge(table: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[When]) -> Change:
    """The first clause that fits a row decides. One full outer join; ``touched`` has ``merge_action`` too. Keys
    that occur more than once in the source are an error where they match; where they don't, each is a new row."""
    for c in clauses:
        if c.do not in _ALLOWED.get(c.kind, set()):
            raise ChangeError(f"WHEN {c.kind} THEN {c.do}")
    require_unique(source.select(*keys).join(table.select(*keys).distinct(), list(keys), "left_semi"), keys, "MERGE")
    j = _sided(table, source, keys, "full")
    state = {
        "matched": F.col(_TARGET).isNotNull() & F.col(_SOURCE).isNotNull(),
        "not matched": F.col(_TARGET).isNull(),
        "not matched by source": F.col(_SOURCE).isNull(),
    }
    which = F.lit(-1)
    for i, c in reversed(list(enumerate(clauses))):
        which = F.when(state[c.kind] & _hit(c.condition), i).otherwise(which)
    j = j.withColumn("__which", which)

    def value(name: str) -> Column:
        out = F.col(name)
        for i, c in enumerate(clauses):
            if c.do in {"update", "insert"}:
                v = c.values.get(name, F.col(name) if c.do == "update" else F.lit(None))
                out = F.when(F.col("__which") == i, v.cast(table.schema[name].dataType)).otherwise(out)
        return out.alias(name)

    action = F.lit(None).cast("string")
    for i, c in enumerate(clauses):
        if c.do != "nothing":
            action = F.when(F.col("__which") == i, F.lit(c.do.upper())).otherwise(action)
    rows = j.select(*[value(c) for c in table.columns], action.alias("merge_action"), F.col(_TARGET))
    after = rows.where(F.coalesce(F.col("merge_action") != "DELETE", F.col(_TARGET).isNotNull())).select(*table.columns)
    return Change(after, rows.where(F.col("merge_action").isNotNull()).drop(_TARGET))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column] | None = None) -> Change:
    """INSERT … ON CONFLICT (keys) DO UPDATE SET ``values`` (which may use ``s.<column>``), or DO NOTHING if None.
    Rows with a null key conflict with nothing."""
    given = rows.where(" and ".join(f"`{k}` is not null" for k in keys))
    if values is None:
        # of new rows with the same key the first goes in, in the order of all their columns
        others = rows.where(" or ".join(f"`{k}` is null" for k in keys))
        pick = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c for c in rows.columns if c not in keys] or keys))
        rows = given.withColumn("__pick", pick).where("__pick = 1").drop("__pick").unionByName(others)
    else:
        require_unique(given, keys, "ON CONFLICT DO UPDATE")
    new = {c: F.col(f"s.{c}") for c in rows.columns}
    on_conflict = When("matched", "nothing") if values is None else When("matched", "update", values)
    return merge(table, rows, keys, [on_conflict, When("not matched", "insert", new)])


@dataclass(frozen=True)
class Constraints:
    """What a table must hold. ``foreign``: columns, the table they refer to, and its columns."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    foreign: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = ()

    def verify(self, rows: DataFrame) -> DataFrame:
        """``rows`` if they hold; else an error that names the constraint. A check that is null holds."""
        for name, broken in {**{f"NOT NULL {c}": F.col(c).isNull() for c in self.not_null}, **{f"CHECK {n}": ~F.coalesce(c, F.lit(True)) for n, c in self.checks.items()}}.items():
            if not rows.where(broken).isEmpty():
                raise ChangeError(f"constraint failed: {name}")
        for key in self.unique:
            given = rows.where(" and ".join(f"`{k}` is not null" for k in key))
            require_unique(given, key, "constraint failed: UNIQUE")
        for columns, other, theirs in self.foreign:
            given = rows.select(*columns).where(" and ".join(f"`{k}` is not null" for k in columns)).distinct()
            keys = other.select(*[F.col(t).alias(c) for c, t in zip(columns, theirs, strict=True)])
            if not given.join(keys, list(columns), "left_anti").isEmpty():
                raise ChangeError(f"constraint failed: FOREIGN KEY {tuple(columns)}")
        return rows
