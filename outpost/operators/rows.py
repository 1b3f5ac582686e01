"""Row picking that the DataFrame API has no single call for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

_RN = "__rn"
#: Rows of a part of a sorted table, about.
PART_ROWS = 250_000


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group under ``order`` (one shuffle on the keys; null keys form a group)."""
    return qualify(df, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), lambda rn: rn == 1)


def qualify(df: DataFrame, window_expr: Column, keep) -> DataFrame:
    """Rows whose window expression passes ``keep``."""
    return df.withColumn(_RN, window_expr).where(keep(F.col(_RN))).drop(_RN)


def limit_by(df: DataFrame, order: Sequence[Column], count: DataFrame, offset: DataFrame | None = None) -> DataFrame:
    """``LIMIT (subquery) [OFFSET (subquery)]``: the one-row frames are evaluated first, so that the sort
    stays a top-k instead of a global window. A null count means no limit, a null offset none skipped."""
    n = count.first()[0]
    skip = (offset.first()[0] if offset is not None else 0) or 0
    out = df.orderBy(*order)
    out = out.offset(int(skip)) if skip else out
    return out if n is None else out.limit(int(n))


def sorted_parts(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """A table of ``n`` rows in this order, in parts that don't grow with it; rows equal in all keys share one."""
    return df.repartitionByRange(max(1, -(-n // PART_ROWS)), *order).sortWithinPartitions(*order)


def numbered(df: DataFrame, orders: dict[str, Sequence[Column]], folder: str) -> DataFrame:
    """For each of ``orders``, a long column of this name with ``row_number() over (order by …)``, which as a
    window would take all rows to one task. The sorted parts are written to ``folder``, so that they are the same
    when their rows are counted and when they are numbered; a row's number is its place in its part and the rows of
    the parts before. The driver gets a count a part."""
    spark, n = df.sparkSession, df.count()
    for k, (name, order) in enumerate(orders.items()):
        rows = sorted_parts(df, order, n).withColumn(name, F.monotonically_increasing_id())
        rows.write.parquet(f"{folder}/{k}")
        rows = spark.read.schema(rows.schema).parquet(f"{folder}/{k}")
        # the id's upper bits are the part, its lower 33 bits the place in it
        part, place = F.shiftright(name, 33).cast("int"), F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
        count = dict(rows.groupBy(part).count().collect())
        before = [0]
        for i in range(max(count, default=0)):
            before.append(before[-1] + count.get(i, 0))
        df = rows.withColumn(name, F.element_at(F.array(*map(F.lit, before)).cast("array<long>"), part + 1) + place + 1)
    return df


def nulls_last(*columns: str, descending: Sequence[str] = ()) -> list[Column]:
    """Sort keys with nulls after all values, ascending unless named in ``descending``."""
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in columns]


def dedupe_names(df: DataFrame) -> DataFrame:
    """Rename repeated column names to ``x, x_1, x_2`` by position."""
    seen: dict[str, int] = {}
    taken = {c.lower() for c in df.columns}
    names = []
    for c in df.columns:
        n = seen.get(c.lower(), 0)
        seen[c.lower()] = n + 1
        name = c
        while n and name.lower() in taken:
            name = f"{c}_{n}"
            n += 1
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)
