import hashlib
import random

import numpy as np
import pytest
from outpost.llm import suffix


def brute(rows):
    first = {}
    for k, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], k)
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            least = first[b[i : i + 50]]
            if least is not None and (k is None or least < k):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **how):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id int, text string, block int, bits string").repartition(3)
    return sorted((tuple(r) for r in suffix.remove_repeats(df, **how).collect()), key=str)


@pytest.mark.parametrize("common", [1, 2, 32])
def test_families(spark, common):
    rng = random.Random(3)
    letters = "abcdefgh é\n"
    pieces = ["".join(rng.choices(letters, k=rng.randrange(20, 140))) for _ in range(12)] + ["ab" * 60, "z" * 200, "De " * 50]
    rows = [(i, "".join(rng.choice(pieces)[rng.randrange(0, 30) :] if rng.random() < 0.8 else "".join(rng.choices(letters, k=9)) for _ in range(rng.randrange(0, 9)))) for i in range(120)]
    rng.shuffle(rows)
    assert got(spark, rows, common_blocks=common) == brute(rows)


def test_edges(spark):
    s = "".join(random.Random(1).choices("abcdefghijklmnop", k=300))
    rows = [(1, None), (1, s), (1, s), (2, ""), (3, s[:49]), (4, s[:50]), (5, s[10:200] + "é" + s[190:]), (None, s), (7, "x" * 49), (8, "x" * 100_000), (9, "x" * 51)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_suffix_order():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[:400]
    order = suffix.SuffixOrder(data)
    starts = rng.permutation(2900)
    group = (starts % 7).astype(np.uint64)
    raw = data.tobytes()
    found = starts[order.sort(starts, group)]
    want = sorted(starts.tolist(), key=lambda i: (i % 7, raw[i : i + 50]))
    assert [(i % 7, raw[i : i + 50]) for i in found] == [(i % 7, raw[i : i + 50]) for i in want]
    x, y = rng.integers(0, 2900, 500), rng.integers(0, 2900, 500)
    plain = [next((k for k in range(50) if raw[a + k] != raw[b + k]), 50) for a, b in zip(x, y, strict=True)]
    assert order.common(x, y).tolist() == plain


def test_a_hash_collision_removes_nothing():
    """With hashes that all agree, equality still rests on the bytes."""
    data = np.frombuffer(bytes(range(60)) + bytes(range(100, 160)), np.uint8)
    order = suffix.SuffixOrder(data)
    order.prefixes.sums[:] = 0
    assert not order.same(np.array([0]), np.array([60])).any() and order.same(np.array([3]), np.array([3])).all()


def test_equal_hashes_of_unequal_stretches(spark, monkeypatch):
    """With all hashes of stretches the same, bytes alone tell them apart."""
    rng = np.random.default_rng(2)
    pool = [bytes(rng.integers(97, 100, 120, np.uint8)) for _ in range(4)]
    texts = [b"".join(pool[i] for i in rng.integers(0, 4, 5)) for _ in range(12)]
    sizes = np.array([len(t) for t in texts], "<i8")
    block = suffix.Block(np.arange(len(texts), dtype="<i8").tobytes(), sizes.tobytes(), b"".join(texts))
    a = block.anchors
    every = (a.first, a.many, a.at, a.hash, a.stretch, a.doc)
    one, least, edges, where = block.stretches(every, 3)
    collided = (*every[:4], np.zeros(len(a.first), np.uint64), a.doc)
    for runs_of in (every, collided):
        one, least, _, where = block.stretches(runs_of, 3)
        data = block.data.tobytes()
        string = lambda i: (data[a.first[i] : a.first[i] + a.many[i] + 49], a.at[i] - a.first[i])
        assert all(string(i) == string(one[where[i]]) and least[where[i]] <= a.doc[i] for i in range(len(a.first)))
