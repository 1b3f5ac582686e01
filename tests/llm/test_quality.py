import math
import random
import re
from collections import Counter

import xxhash
from outpost.llm import quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at, covered, lines, dup = {}, set(), set(), 0
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    for starts in at.values():
        if len(starts) > 1:
            covered |= {s + k for s in starts for k in range(5)}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["\n", " ", "\t\x0b"]).join(rng.choices(["a", "b#", "é|", "ccc", "\x1f", "日"], k=rng.randrange(40)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \n \n"), (903, "x y z w v " * 4000), (904, "a\n\na\na\n"), (905, "one two three four five"), (905, "other text")]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id int, text string, n_words int, grams string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id int, quality int")
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(df, labels).collect())
    assert got == sorted((k, *brute(t)) for k, t in rows)


def test_empty_and_unlabelled(spark):
    df = spark.createDataFrame([(1, "some words " * 1), (2, " ".join(f"w{i}" for i in range(30)))], "doc_id int, text string")
    labels = spark.createDataFrame([], "doc_id int, quality int")
    assert {r.doc_id: r.kept for r in quality.judge(df, labels).collect()} == {1: False, 2: True}
    assert quality.judge(df.limit(0), labels).collect() == []


def grams_of(text, buckets):
    """Buckets of all words and of all pairs of neighbours, from the text itself."""
    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    one = [xxhash.xxh64_intdigest(x, 42) for x in w]
    two = [xxhash.xxh64_intdigest(b, h) for h, b in zip(one, w[1:])]
    # signed 64-bit integers and a number of buckets that divides 2**64
    return [h % buckets for h in one + two]


def brute_scores(docs, good, buckets):
    all_, target = Counter(), Counter()
    for k, grams in docs:
        all_.update(grams)
        if k in good:
            target.update(grams)
    n, m = sum(all_.values()), sum(target.values())
    ratio = {b: round(math.log((target[b] + 1) / (m + buckets) / ((all_[b] + 1) / (n + buckets))) * 1_000_000) for b in all_}
    # whole division towards zero, as in SQL
    return {k: int(sum(ratio[b] for b in grams) / len(grams)) if grams else None for k, grams in docs}


def test_ngrams(spark):
    texts = ["one", "", None, "a b", "a b a b\n\tc", " é  日本 \x0b x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: list(r.grams) for r in quality.statistics(df).collect()}
    assert got == {i: grams_of(t, quality.BUCKETS) for i, t in enumerate(texts)}
    assert [len(got[i]) for i in range(4)] == [1, 0, 0, 3]


def test_scores(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    grams = [(r.doc_id, grams_of(r.text, quality.BUCKETS)) for r in docs.collect()]
    want = brute_scores(grams, {r.doc_id for r in labels.collect() if r.quality == 1}, quality.BUCKETS)
    got = quality.judge(docs, labels).collect()
    assert len(got) == len(grams)
    for r in got:
        assert abs((r.score or 0) - (want[r.doc_id] or 0)) <= 1
        assert r.kept == (not r.base_failed and (r.score or 0) >= quality.THRESHOLD)


def test_long_text_and_clashing_columns(spark):
    long = " ".join(f"w{i % 700}x{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long), (2, "a few words")], "doc_id int, text string")
    for c in ("row", "grams", "kept", "score", "__sum", "n_words", "m"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    labels = spark.createDataFrame([(1, 1)], "doc_id int, quality int")
    r = {r.doc_id: r for r in quality.judge(df, labels).collect()}
    assert (r[1].n_words, r[1].n_repeat_words, r[1].kept, r[2].base_failed) == (200_000, 0, True, True)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and [x.asDict() for x in kept.collect()] == [x.asDict() for x in df.where("doc_id = 1").collect()]


def test_held_out_labels(spark):
    """Fitted on half of the labels, it tells the other half's good from bad documents."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality.judge(docs, labels.where("doc_id % 2 = 0")).where("not base_failed").collect()}
    held = [(verdict[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect() if r.doc_id in verdict]
    good, bad = [v for v, q in held if q == 1], [v for v, q in held if q == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.3 * len(bad)
