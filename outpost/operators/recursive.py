"""Recursive queries whose arms are combined with duplicates removed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F


class _Found:
    """Rows found so far, each round's written once to the session's checkpoint folder."""

    def __init__(self, base: DataFrame):
        root = base.sparkSession.sparkContext.getCheckpointDir()
        if not root:
            raise RuntimeError("a recursive query needs a checkpoint folder")
        self.spark, self.columns, self.schema = base.sparkSession, base.columns, base.schema
        self.path, self.rounds = f"{root}/closure-{uuid.uuid4().hex}", 0

    def write(self, rows: DataFrame) -> DataFrame:
        """Another round's rows. Columns by position, with the names and types of the base."""
        rows = rows.toDF(*self.columns).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema])
        path, self.rounds = f"{self.path}/{self.rounds}", self.rounds + 1
        rows.write.parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)


def closure(base: DataFrame, step: Callable[[DataFrame], DataFrame], max_rounds: int = 1000) -> DataFrame:
    """``WITH RECURSIVE … UNION``: rows of ``base`` and of ``step`` over the rows found last, each once, until
    a round finds no new ones. Each round's new rows are written once, to the session's checkpoint folder, so
    plans stay short and a lost executor costs a reread. Raises if ``max_rounds`` are not enough, or without a
    checkpoint folder. Takes as many rounds as the longest chain has steps; where that grows with the input and
    the arms are maps that commute, ``orbit`` takes its logarithm."""
    every = _Found(base)
    fresh = every.write(base.distinct())
    for _ in range(max_rounds):
        found = every.read()
        fresh = every.write(step(fresh).subtract(found))
        if fresh.isEmpty():
            return found
    raise RuntimeError(f"still new rows after {max_rounds} rounds")


def orbit(base: DataFrame, powers: Sequence[Callable[[DataFrame, int], DataFrame]], max_rounds: int = 60) -> DataFrame:
    """``closure`` where the step is the union of several maps, each of a row to one row, that commute: rows of
    ``base`` and what any number of applications of the maps makes of them, each once. Each of ``powers`` gives the
    rows after so many applications of its map. A map is taken to its closure before the next one; its rounds
    apply it 1, 2, 4, … times to all rows found, so 2**k applications take k rounds. A round that finds nothing new
    ends it: then all rows so many applications away, the first one beyond those found included, are known. Writes
    and raises as ``closure``, ``max_rounds`` being those of one map."""
    every = _Found(base)
    every.write(base.distinct())
    for power in powers:
        for k in range(max_rounds):
            found = every.read()
            if every.write(power(found, 2**k).subtract(found)).isEmpty():
                break
        else:
            raise RuntimeError(f"still new rows after {max_rounds} rounds")
    return every.read()
