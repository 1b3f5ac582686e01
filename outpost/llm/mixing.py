"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are handed out in blocks of equal size. Blocks go to sources by the highest quotients
``target / (2 j + 1)``; the quota of a source goes to groups of its shards, and that of a group to its shards,
by the highest quotients of their sizes. What a source's quota misses of its target, or has too much, is less
than a few blocks; its shard with the largest quota takes that many words more or fewer, so small sources
come to their targets too. Each shard takes its words from its documents, which stand in seeded order: a shard
that must give more than it has gives whole passes first, then seeded blocks spaced evenly over it, one of them
cut to what is left. Of a document taken in part, the words of just its picked blocks are taken, wherever in it
they are.

DataFrame functions only. The documents are never collected by source: a source is cut into shards of about
``shard_words`` words by a seeded hash of id and size, so a source with a third of all rows has more shards, not
larger ones, and a shard's group has at most about ``GROUP_SHARDS`` of them. What is small is one row per source
and one per shard; all sources stand in one window, which wants one task to sort a row each.

Defined results. A null or empty text has size 0 and takes 0 words. A null source is a source of its own.
Repeated ids are separate rows; those of equal size stand in the same shard. Ties of quotients go to the source
or shard that comes first, null last. A very long text is one row of its shard, which then is larger. No rows or
no words at all: every target and ``taken`` is 0. A weight that is null or not above 0 counts as 0. Only the id,
source and size columns are read, so that other columns can't clash; a source missing in ``weights`` has
weight 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from outpost.llm.identity import KEYS, identified
from outpost.llm.store import write_table
from outpost.llm.words import WORD, word_count
from outpost.operators.joins import lookup_join

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 18
#: Shards in a group, about.
GROUP_SHARDS = 4096
MOST_PASSES = 3
SEED = 20240501


def targets(sources: DataFrame, passes: int = MOST_PASSES) -> DataFrame:
    """``sources(source, weight, source_size)`` with a double ``target``: all words shared by weight, none
    above ``passes`` times its source's size, the excess shared again by weight.

    The level ``l`` in ``target = min(cap, l * weight)`` has a closed form: with sources ordered by
    ``cap / weight``, the first ``k`` stop at their caps and the rest share what is left."""
    cap = F.col("source_size") * F.lit(float(passes))
    w = F.when(F.col("weight") > 0, F.col("weight").cast("double")).otherwise(0.0)
    s = sources.withColumns({"__w": w, "__cap": F.when(w > 0, cap).otherwise(0.0)})
    s = s.withColumn("__fill", F.when(F.col("__w") > 0, F.col("__cap") / F.col("__w")).otherwise(0.0))
    every = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("__fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "__all": F.sum(F.col("source_size").cast("double")).over(every),
        "__caps": F.coalesce(F.sum("__cap").over(before), F.lit(0.0)),
        "__rest": F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)),
    })
    # the level if this source and all after it are below their caps; the right one is the first that it can bear
    s = s.withColumn("__level", F.when(F.col("__w") > 0, (F.col("__all") - F.col("__caps")) / F.col("__rest")))
    s = s.withColumn("__level", -F.min(F.when(F.col("__level") <= F.col("__fill"), F.struct("__fill", (-F.col("__level")).alias("__down")))).over(every)["__down"])
    target = F.when(F.col("__w") <= 0, 0.0).when(F.col("__level").isNull(), F.col("__cap")).otherwise(F.least("__cap", F.col("__level") * F.col("__w")))
    return s.withColumn("target", target).drop("__w", "__cap", "__fill", "__all", "__caps", "__rest", "__level")


def sainte_lague(df: DataFrame, share: str, seats: Column, group: list[str], tie: list[Column], out: str) -> DataFrame:
    """Add ``out``: the seats of each row when ``seats`` of its group go to the highest quotients
    ``share / (2 j + 1)``, ties by ``tie``.

    The divisor of the result is within half a seat a row of the exact one, so each row surely holds all
    quotients below a bound and surely none above another; only those between are listed and ranked, about
    three a row."""
    whole = Window.partitionBy(*group)
    d = df.withColumns({"__seats": seats.cast("double"), "__share": F.greatest(F.col(share).cast("double"), F.lit(0.0))})
    d = d.withColumns({"__sum": F.sum("__share").over(whole), "__n": F.count(F.lit(1)).over(whole)})
    part = F.when(F.col("__sum") > 0, F.col("__share") / F.col("__sum")).otherwise(0.0)
    exact, slack = part * F.col("__seats"), part * F.col("__n") / 2 + 0.5 + 1e-6
    d = d.withColumns({"__low": F.greatest(F.floor(exact - slack), F.lit(0)).cast("long"), "__high": F.ceil(exact + slack).cast("long")})
    d = d.withColumn("__left", F.col("__seats") - F.sum("__low").over(whole))
    j = F.explode_outer(F.when(F.col("__share") > 0, F.sequence("__low", "__high")))
    quotient = F.col("__share") / (2 * F.col("__j") + 1)
    ranked = d.withColumn("__j", j).withColumn("__rank", F.row_number().over(whole.orderBy(quotient.desc_nulls_last(), *tie, "__j")))
    won = F.sum(F.when(F.col("__j").isNotNull() & (F.col("__rank") <= F.col("__left")), 1).otherwise(0))
    keep = [F.first(c).alias(c) for c in df.columns if c not in group]
    keys = [*group, "__row"]
    numbered = ranked.withColumn("__row", F.struct(*[F.col(c) for c in df.columns if c not in group]))
    return numbered.groupBy(*keys).agg(*keep, (F.first("__low") + won).cast("long").alias(out)).drop("__row")


def mix(docs: DataFrame, weights: DataFrame, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, passes: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """``docs(doc_id, source, size)`` and ``weights(source, weight)`` to
    ``doc_id, source, size, source_size, target, quota, taken``: the words that the mix takes of each row,
    at most ``passes`` times its size. ``start`` is the row's place in its shard, the columns of ``PICKS`` tell
    which of the shard's words ``picked`` takes once more."""
    docs = write_table(docs.select("doc_id", "source", "size"), "sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    sized = lookup_join(sizes, weights.select("source", "weight"), ["source"], "left")
    goal = targets(sized, passes).drop("weight")
    blocks = F.round(F.sum("source_size").over(Window.partitionBy("__one")) / F.lit(block))
    goal = goal.withColumn("__one", F.lit(0)).withColumn("__blocks", blocks)
    goal = sainte_lague(goal, "target", F.col("__blocks"), ["__one"], [F.col("source").asc_nulls_last()], "quota")
    goal = goal.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / F.lit(shard_words)), F.lit(1)).cast("long"))
    goal = write_table(goal.select("source", "source_size", "target", "quota", "shards"), "goals")

    dealt = lookup_join(docs, goal.select("source", "shards"), ["source"]).withColumns({
        "shard": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("shards")), "__order": F.xxhash64(F.lit(seed), "doc_id"),
    })
    shards = write_table(dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")), "shards")
    plan = write_table(shard_plan(shards, goal, block, passes, seed), "plan")
    before = Window.partitionBy("source", "shard").orderBy("__order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.drop("shards").withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    m = lookup_join(placed, plan, ["source", "shard"])

    start, end, picks = F.col("start"), F.col("start") + F.col("size"), [F.col(c) for c in PICKS]
    touched = F.sequence(F.floor(start / block), F.floor((end - 1) / block))
    until = lambda b: b * block + F.when(b == F.col("cut"), F.col("cut_words")).when(picked(b * block, *picks, block=block), block).otherwise(0)
    words = F.aggregate(touched, F.lit(0).cast("long"), lambda acc, b: acc + F.greatest(F.least(end, until(b)) - F.greatest(start, b * block), F.lit(0)))
    taken = F.when(F.col("size") <= 0, F.lit(0)).otherwise(F.col("whole_passes") * F.col("size") + words)
    return m.select("doc_id", "source", "size", "source_size", "target", "quota", taken.cast("long").alias("taken"), "start", *PICKS)


#: What ``picked`` knows of a shard: its whole blocks, from where they are counted, how many are picked, and the
#: block of which only the first words are.
PICKS = ["blocks", "phase", "more", "cut", "cut_words"]


def picked(word: Column, blocks: Column, phase: Column, more: Column, cut: Column, cut_words: Column, block: int = BLOCK_WORDS) -> Column:
    """Whether a word of a shard, by its place, is one of those that are taken once more: of the whole blocks,
    spaced evenly from a seeded phase on, exactly ``more``."""
    b = F.floor(word / F.lit(block))
    whole = (b < blocks) & (F.pmod((b + phase) * more, F.greatest(blocks, F.lit(1))) < more)
    return F.when(b == cut, word - b * block < cut_words).otherwise(whole)


def shard_plan(shards: DataFrame, goal: DataFrame, block: int, passes: int, seed: int) -> DataFrame:
    """``source, shard, source_size, target, quota, whole_passes`` and ``PICKS`` of every shard, from
    ``shards(source, shard, shard_size)`` and the sources' ``goal``."""
    s = lookup_join(shards, goal, ["source"])
    s = s.withColumn("group", F.pmod(F.col("shard"), F.ceil(F.col("shards") / F.lit(GROUP_SHARDS))))
    groups = s.groupBy("source", "group").agg(F.sum("shard_size").alias("group_size"), F.first("quota").alias("quota"))
    groups = sainte_lague(groups, "group_size", F.col("quota"), ["source"], [F.col("group")], "group_quota")
    s = lookup_join(s, groups.select("source", "group", "group_quota"), ["source", "group"])
    s = sainte_lague(s, "shard_size", F.col("group_quota"), ["source", "group"], [F.col("shard")], "shard_quota")
    # the words that the source's blocks miss go to, or come from, its shard with the largest quota
    most = s.groupBy("source").agg(F.min_by("shard", F.struct((-F.col("shard_quota")).alias("q"), "shard")).alias("most"))
    s = lookup_join(s, most, ["source"])
    rest = F.when(F.col("shard") == F.col("most"), F.round("target") - F.col("quota") * block).otherwise(0)
    want, all_ = (F.col("shard_quota") * block + rest).cast("long"), F.col("shard_size") * passes
    # a source whose target is all that it may give has no shard that may give less
    want = F.when(F.round("target") >= F.col("source_size") * passes, all_).otherwise(F.greatest(want, F.lit(0).cast("long")))
    s = s.withColumn("want", F.least(want, all_))
    some = F.greatest("shard_size", F.lit(1).cast("long"))
    s = s.withColumns({"whole_passes": F.floor(F.col("want") / some).cast("long"), "left": F.col("want") % some, "blocks": F.floor(F.col("shard_size") / F.lit(block)).cast("long")})
    s = s.withColumns({"more": F.floor(F.col("left") / F.lit(block)).cast("long"), "cut_words": F.col("left") % block})
    s = s.withColumn("phase", F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.greatest("blocks", F.lit(1).cast("long"))))
    # words below a block: the head of a picked block if one is left (that at the phase always is), else of the tail
    inside = (F.col("cut_words") > 0) & (F.col("more") < F.col("blocks"))
    cut = F.when(inside, F.pmod(-F.col("phase"), F.col("blocks"))).when(F.col("cut_words") > 0, F.col("blocks")).otherwise(-1)
    s = s.withColumn("cut", cut.cast("long")).withColumn("more", F.col("more") + inside.cast("long"))
    return s.select("source", "shard", "source_size", "target", "quota", "whole_passes", *PICKS)


def cycled_weights(docs: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """``source, weight``: sources in code point order, null last, weigh the values of ``cycle`` in turn."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return docs.select("source").distinct().withColumn("weight", F.element_at(values, (rank % len(cycle) + 1).cast("int")))


def take(docs: DataFrame, weights: DataFrame, block: int = BLOCK_WORDS, **method: int) -> DataFrame:
    """The mix itself, with the columns of ``docs(doc_id, text, source, …)``: each row as many times as the
    mix takes it whole, and once more with the words of its picked blocks if it takes a part. Words keep the
    white space before them, but for the first of a part that isn't the first of its text. A row is known by
    its id, text and source, null or not; rows equal in these count once for the mix and are taken alike."""
    pieces = F.filter(F.split("row.text", "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"), lambda x: x.rlike(WORD))
    rows = identified(docs, "text", "source")
    sizes = rows.select(F.struct(*KEYS).alias("doc_id"), "row.source", word_count(F.col("row.text")).alias("size")).dropDuplicates(["doc_id"])
    taken = mix(sizes, weights, block=block, **method).where("taken > 0").select("doc_id.*", "size", "taken", "start", *PICKS)
    rows = rows.join(write_table(taken, "taken"), KEYS)
    whole, rest = F.expr("taken div size"), F.col("taken") % F.col("size")
    at = lambda i: picked(F.col("start") + i, *[F.col(c) for c in PICKS], block=block)
    words = F.array_join(F.filter(pieces, lambda _, i: at(i)), "")
    words = F.when(at(F.lit(0)), words).otherwise(F.regexp_replace(words, "^[\\x20\\x09-\\x0D]+", ""))
    part = F.when(rest > 0, F.array(words)).otherwise(F.array().cast("array<string>"))
    rows = rows.select("row", F.explode(F.concat(F.array_repeat("row.text", whole.cast("int")), part)).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
