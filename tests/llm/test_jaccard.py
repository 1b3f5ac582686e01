import random
import re

import pytest
from outpost.llm import components, jaccard
from outpost.operators import joins

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=80):
    sets = [(k, shingles(t)) for k, t in rows]
    label = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= threshold * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (k, _), x in zip(sets, label, strict=True):
        least[x] = min(k, least.get(x, k))
    return sorted((k, len(s), least[x]) for (k, s), x in zip(sets, label, strict=True))


def got(spark, rows, **how):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id int, text string, key string, label int")
    return sorted(tuple(r) for r in jaccard.join(df, **how).collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("boundary", [None, 0, 60, 10**6])
def test_random_families(spark, boundary):
    """Chains of near copies, one long passage in many short texts, and texts of its parts."""
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for size in (5, 6, 9, 12, 30, 70, 150):
        words = rng.choices(vocabulary, k=size)
        for _ in range(7):
            rows.append(words)
            words = edited(rng, words, rng.randrange(3))
    for _ in range(40):
        cut = rng.randrange(0, 12)
        rows.append(passage[cut:] + rng.choices(vocabulary, k=rng.randrange(0, 14)))
    rows += rng.sample(rows, 20)
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    assert got(spark, rows, boundary=boundary) == brute(rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(3, None), (4, ""), (5, " \n"), (6, "a b"), (7, "A  B"), (8, "a b c"), (9, long), (10, long + " more"), (11, "a b"), (11, "a b"), (12, "É b c d e f"), (13, "é b c d e f")]
    want = brute(rows)
    assert got(spark, rows) == want
    assert dict((k, c) for k, _, c in want)[10] == 9
    assert got(spark, []) == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 3), (20, 21), (30, 30)] + [(i, i + 1) for i in range(100, 160)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.label for r in components.components(df).collect()}
    assert {k: found[k] for k in (1, 2, 3, 8, 9, 20, 21)} == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    assert all(found[i] == 100 for i in range(100, 161)) and 30 not in found
    assert components.components(df.limit(0)).collect() == []


def test_split_keys(spark, monkeypatch):
    """Every key of more than three rows in pieces: the same components, whichever way the rows meet."""
    few = {"hot_keys": lambda df, keys: joins.hot_keys(df, keys, 3), "hot_counts": lambda c, keys, n, total: joins.hot_counts(c, keys, n, total, 3)}
    for name, f in few.items():
        monkeypatch.setattr(jaccard, name, f)
    monkeypatch.setattr(jaccard, "paired", lambda x, y, key, many, salt: joins.paired(x, y, key, many, salt, 3))
    monkeypatch.setattr(components, "hot_keys", few["hot_keys"])
    rng = random.Random(9)
    words = [f"v{i}" for i in range(40)]
    rows = [edited(rng, words, rng.randrange(5)) for _ in range(60)] + [words] * 12
    rows += [words[:20] + [f"x{rng.randrange(10**6)}" for _ in range(20)] for _ in range(20)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    for rounds in (0, 2):
        assert got(spark, rows, rounds=rounds) == brute(rows)


def test_rows_without_ids(spark):
    """Very many rows with a null or the same id are told apart by their texts."""
    rng = random.Random(3)
    base = [f"v{i}" for i in range(120)]
    texts = [" ".join(edited(rng, base, 2)) for _ in range(40)]
    df = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)] + [(1, " ".join(base))], "doc_id int, text string")
    out = jaccard.join(df)
    assert out.count() == 41
    linked = {i for i, t in enumerate(texts) if 100 * len(shingles(t) & shingles(" ".join(base))) >= 80 * len(shingles(t) | shingles(" ".join(base)))}
    assert out.where("component_id = 1").count() >= len(linked) + 1 > 20
