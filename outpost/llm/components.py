"""Connected components of an edge table by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from outpost.llm.store import write_table
from outpost.operators.joins import hot_keys, salted_join


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` for every node of ``edges(a, b)``; nodes that are connected get one label, the smallest
    id among them. Each round hooks every node to its smallest neighbour, follows the hooks to their roots in
    doubling steps, and keeps the edges between different roots; the number of nodes at least halves. All
    rounds are written to the shared folder; nothing is collected but which nodes very many others hang on,
    which are dealt to several tasks."""
    e = edges.where("a <> b").select("a", "b")
    e = write_table(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = None
    while not e.isEmpty():
        up = write_table(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("up")), "hooks")
        while True:
            over = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
            nxt = write_table(salted_join(up, over, ["up"], ["id"], hot_keys(up, ["up"])).select("id", F.col("top").alias("new"), (F.col("top") != F.col("up")).alias("moved")), "hooks")
            up = nxt.select("id", F.col("new").alias("up"))
            if nxt.where("moved").isEmpty():
                break
        if labels is None:
            labels = up.select("id", F.col("up").alias("label"))
        else:
            moved = up.select(F.col("id").alias("label"), "up")
            labels = write_table(salted_join(labels, moved, ["label"], ["id"], hot_keys(labels, ["label"]), "left").select("id", F.coalesce("up", "label").alias("label")), "labels")
        a, b = up.select(F.col("id").alias("a"), F.col("up").alias("ra")), up.select(F.col("id").alias("b"), F.col("up").alias("rb"))
        both = salted_join(salted_join(e, a, ["a"], ["b"], hot_keys(e, ["a"])), b, ["b"], ["a"], hot_keys(e, ["b"]))
        e = write_table(both.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if labels is None:
        return e.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labels
