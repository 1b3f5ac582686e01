"""Joins whose build side is broadcast only when it has been measured, and joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows, and bytes of their text and binary columns, up to which a small side is broadcast.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 << 20
#: Rows of one key up to which it is never split, and the part of all rows up to which it is not.
HOT_ROWS = 512
HOT_SHARE = 10_000
#: Salt of the pieces of a hot key.
SEED = 4711


def _small(df: DataFrame, most: int) -> bool:
    wide = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    size = sum(wide, F.lit(0)).cast("long")
    found = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return found["n"] <= most and found["size"] <= BROADCAST_BYTES


def lookup_join(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """Join a dimension by ``keys`` (null-safe: a null key meets a null key). It is broadcast if it has at most
    ``most`` rows and ``BROADCAST_BYTES`` of text, which is measured first; else it is a shuffled join, whose
    skewed partitions adaptive execution splits."""
    right = small.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = [df[k].eqNullSafe(right[f"__r_{k}"]) for k in keys]
    if _small(small, most):
        right = F.broadcast(right)
    return df.join(right, cond, how).drop(*[f"__r_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, share: int = HOT_SHARE) -> DataFrame | None:
    """``keys, __pieces``: keys of more than ``rows`` rows and more than one in ``share`` of all rows, and into
    how many pieces they are split. There are at most ``share`` of them, whatever the input; None for none.
    df: a table, as it is read more than once."""
    total = df.count()
    return hot_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), keys, "__n", total, rows, share) if total > rows else None


def hot_counts(counts: DataFrame, keys: list[str], n: str, total: int, rows: int = HOT_ROWS, share: int = HOT_SHARE) -> DataFrame | None:
    """As ``hot_keys``, where the rows ``n`` of each key and of all of them are known."""
    limit = max(rows, -(-total // share))
    hot = counts.where(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / F.lit(limit)).cast("int").alias("__pieces"))
    found = hot.collect()
    return hot.sparkSession.createDataFrame(found, hot.schema) if found else None


def salted_join(df: DataFrame, right: DataFrame, keys: list[str], salt: list[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Equi-join by ``keys``, inner or left, that deals the rows of the keys ``hot`` (see ``hot_keys``) of ``df``
    to several tasks by a hash of the columns ``salt``; the rows that ``right`` has of such a key go to each of
    them. ``right`` should have few rows a key. Null keys meet nothing."""
    if hot is None:
        return df.join(right, keys, how)
    hot = F.broadcast(hot)
    pieces = F.coalesce(F.col("__pieces"), F.lit(1))
    left = df.join(hot, keys, "left").withColumn("__piece", F.pmod(F.xxhash64(F.lit(SEED), *salt), pieces).cast("int")).drop("__pieces")
    many = right.join(hot, keys, "left").withColumn("__piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("__pieces")
    return left.join(many, [*keys, "__piece"], how).drop("__piece")


def paired(x: DataFrame, y: DataFrame, key: str, many: str, salt: tuple[str, str], rows: int = HOT_ROWS) -> DataFrame:
    """Self-join by ``key`` of two sides with columns of different names but for ``key`` and ``many``, the number
    of rows of the key. A key of more than ``rows`` rows is split by a hash of each side's own ``salt``, and the
    pieces meet pairwise, each pair of pieces in a group of its own."""
    pieces = F.greatest(F.ceil(F.col(many) / F.lit(rows)), F.lit(1)).cast("int")
    piece = lambda c: F.pmod(F.xxhash64(F.lit(SEED), F.col(c)), pieces).cast("int")
    every = F.explode(F.sequence(F.lit(0), pieces - 1))
    a = x.withColumn("__px", piece(salt[0])).withColumn("__py", every).drop(many)
    b = y.withColumn("__py", piece(salt[1])).withColumn("__px", every).drop(many)
    return a.join(b, [key, "__px", "__py"]).drop("__px", "__py")
