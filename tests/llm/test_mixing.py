import random
from collections import Counter

import pytest
from outpost.llm import mixing
from pyspark.sql import functions as F


def brute_targets(sizes, weights, passes=3):
    """Share by weight, stop the ones above their caps, share their excess again."""
    total, target, stopped = sum(sizes.values()), {s: 0.0 for s in sizes}, set()
    while True:
        left = total - sum(passes * sizes[s] for s in stopped)
        w = sum(weights[s] for s in sizes if s not in stopped)
        if not w:
            break
        target = {s: passes * sizes[s] if s in stopped else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in stopped and target[s] > passes * sizes[s]}
        if not over:
            break
        stopped |= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50_000, 10**7]) for i in range(17)}
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(sizes))}
    df = spark.createDataFrame([(s, weights[s], n) for s, n in sizes.items()], "source string, weight double, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes, weights), rel=1e-9, abs=1e-6)


def brute_seats(shares, seats):
    won = Counter()
    for _ in range(seats):
        won[max(shares, key=lambda s: (shares[s] / (2 * won[s] + 1), [-ord(c) for c in s]))] += 1
    return {s: won[s] for s in shares}


@pytest.mark.parametrize("seed", range(6))
def test_sainte_lague(spark, seed):
    rng = random.Random(seed)
    shares = {f"p{i:02}": rng.choice([0.0, rng.random() * 5, rng.random() * 1000, 7.0]) for i in range(rng.randrange(2, 25))}
    shares["p00"] = 3.0
    seats = rng.choice([0, 1, 7, 200, 1500])
    df = spark.createDataFrame([(1, s, x) for s, x in shares.items()], "g int, party string, share double")
    got = {r.party: r.seats for r in mixing.sainte_lague(df, "share", F.lit(seats), ["g"], [F.col("party")], "seats").collect()}
    assert got == brute_seats(shares, seats)


def mixed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id int, source string, size long").withColumn("taken", F.lit("clash"))
    return df, mixing.mix(df, mixing.cycled_weights(df), **how)


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", "c", "d", None, "é"]), rng.choice([0, 3, 40, 900, 5000])) for i in range(1500)]
    rows += rows[:10]
    df, out = mixed(spark, rows, shard_words=60_000)
    got = out.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    again = Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(df.repartition(7), mixing.cycled_weights(df), shard_words=60_000).collect())
    assert again == Counter((r.doc_id, r.size, r.taken) for r in got)
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    for s, want in brute_targets(sizes, weights).items():
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(want) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - want) <= 1


@pytest.mark.parametrize("sizes", [[3, 10, 20, 200_000], [1, 1, 2, 63, 64, 65, 10**6], [20, 5000, 64 * 300]])
def test_small_sources(spark, sizes):
    rows, rng = [], random.Random(sum(sizes))
    for k, n in enumerate(sizes):
        while n:
            rows.append((len(rows), f"s{k}", min(n, rng.choice([1, 2, 7, 70, 900, 30_000]))))
            n -= rows[-1][2]
    got = mixed(spark, rows, shard_words=50_000)[1].collect()
    want = brute_targets({f"s{k}": n for k, n in enumerate(sizes)}, {f"s{k}": (5.0, 2.0, 1.0)[k % 3] for k in range(len(sizes))})
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, x in want.items():
        assert abs(taken[s] - x) <= 1


def test_taken_words_one_by_one(spark):
    """Each shard laid out word by word: passes, and the picked words of every row."""
    rng = random.Random(5)
    rows = [(i, rng.choice("abcd"), rng.choice([0, 1, 5, 63, 64, 65, 300, 2000])) for i in range(400)]
    got = mixed(spark, rows, shard_words=20_000, block=16)[1]
    assert got.where("size > 0 and taken % size > 0").groupBy("source").count().count() > 1
    word = F.explode(F.sequence(F.lit(0), F.col("size") - 1))
    at = mixing.picked(F.col("start") + F.col("w"), *[F.col(c) for c in mixing.PICKS], block=16)
    once = {r.doc_id: r.n for r in got.where("size > 0").select("*", word.alias("w")).where(at).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    passes = Counter()
    for r in got.collect():
        passes[r.source, r.size and (r.taken - once.get(r.doc_id, 0)) // r.size] += r.size > 0
        assert not r.size or (r.taken - once.get(r.doc_id, 0)) % r.size == 0
    assert all(len({p for (s, p), n in passes.items() if s == src and n}) <= 2 for src in "abcd")


def test_shards_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 3)
    rows = [(i, "ab"[i % 5 == 0], 100 + i % 700) for i in range(2000)]
    got = mixed(spark, rows, shard_words=20_000)[1].collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    for s, x in brute_targets(sizes, {"a": 5.0, "b": 2.0}).items():
        assert abs(taken[s] - x) <= 1


def test_edges(spark):
    assert mixed(spark, [])[1].collect() == []
    only = mixed(spark, [(1, "a", 0), (2, None, 0)])[1].collect()
    assert {(r.doc_id, r.target, r.taken) for r in only} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert [r.taken for r in mixed(spark, [(1, "a", 1000)])[1].collect()] == [1000]


def in_order(words, all_words):
    """Whether words are some of all words, in their order."""
    rest = iter(all_words)
    return all(w in rest for w in words)


def test_take(spark):
    rows = [(1, "a b\n c  d ", "x"), (2, None, "x"), (3, "", None), (4, " ".join(["w"] * 700), "y")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id int, text string, source string, n_chars long")
    out = mixing.take(df, mixing.cycled_weights(df), block=2)
    assert out.columns == df.columns
    texts = {r[0]: r[1] or "" for r in rows}
    for r in out.collect():
        assert in_order(r.text.split(), texts[r.doc_id].split()) and r.n_chars == len(r.text)
    assert mixing.take(df.limit(0), mixing.cycled_weights(df)).collect() == []


def test_take_emits_the_picked_blocks(spark):
    texts = {k: f"\n w{k}_0" + "".join(f"  w{k}_{i}" for i in range(1, 6400)) for k in range(6)}
    df = spark.createDataFrame([(k, t, "x" if k < 2 else "y") for k, t in texts.items()], "doc_id int, text string, source string")
    weights = mixing.cycled_weights(df)
    out = mixing.take(df, weights).collect()
    places = {r.doc_id: [int(w.split("_")[1]) for w in r.text.split()] for r in out if r.text != texts[r.doc_id]}
    assert set(places) == set(texts), "x is taken 2.14 times, y 0.43 times"
    cut = Counter()
    for k, at in places.items():
        assert all(w.startswith(f"w{k}_") for r in out if r.doc_id == k for w in r.text.split())
        assert at == sorted(set(at)) and at[0] < 640 and at[-1] >= 5760, "heads as well as tails"
        halves = Counter(i // 3200 for i in at)
        assert abs(halves[0] - halves[1]) <= 192
        parts = [n for n in Counter(i // 64 for i in at).values() if n < 64]
        cut["x" if k < 2 else "y"] += len(parts)
    assert max(cut.values()) <= 1, "whole blocks, as all sizes are multiples of 64, but for one a source that gives what is left"
    words = Counter()
    for r in out:
        words["x" if r.doc_id < 2 else "y"] += len(r.text.split())
    taken = mixing.mix(df.select("doc_id", "source", F.lit(6400).cast("long").alias("size")), weights).groupBy("source").agg(F.sum("taken")).collect()
    assert words == dict(taken)
