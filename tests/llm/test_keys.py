"""Stages on rows with null and repeated ids, and with columns named like those that operators add."""

from outpost.llm import jaccard, mixing, pii, quality
from test_mixing import in_order

WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
CLASHING = ["id", "hash", "row", "taken", "size", "label", "first", "__hash", "__taken", "key", "quota", "kept"]


def table(spark, rows):
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, len(r[1] or ""), *[f"{c}{i}" for c in CLASHING]) for i, r in enumerate(rows)], schema)


def text(k):
    return " ".join(f"{w}{k}" for w in WORDS)


ROWS = [
    (1, text(1), "a"), (2, text(1), "a"), (None, text(1), None), (None, text(2), "b"), (None, text(3), None),
    (3, text(4), "b"), (3, text(5), "b"), (4, None, "a"), (4, "", "a"), (None, None, None), (5, text(5), None),
]


def test_near_duplicates(spark):
    got = jaccard.one_of_each(table(spark, ROWS))
    kept = {(r.doc_id, r.text) for r in got.collect()}
    assert kept == {(1, text(1)), (None, text(2)), (None, text(3)), (3, text(4)), (3, text(5)), (4, None), (4, ""), (None, None)}
    assert got.count() == len(kept)
    # columns of the row stay what they were
    assert all(r.hash[4:] == r.id[2:] == r["__hash"][6:] == r.kept[4:] for r in got.collect())


def test_quality(spark):
    docs = table(spark, ROWS)
    labels = spark.createDataFrame([(1, 1), (None, 1)], "doc_id long, quality int")
    got = quality.keep_good(docs, labels, threshold=-(10**9))
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in docs.collect() if r.text)


def test_mixing(spark):
    docs = table(spark, ROWS)
    got = mixing.take(docs, mixing.cycled_weights(docs), block=1)
    assert got.columns == docs.columns
    rows = {r.key: r for r in docs.collect()}
    taken = got.collect()
    assert taken and all(in_order(r.text.split(), rows[r.key].text.split()) and r["__taken"] == rows[r.key]["__taken"] and r.n_chars == len(r.text) for r in taken)
    assert any(r.doc_id is None for r in taken)


def test_personal_data(spark):
    docs = table(spark, ROWS)
    assert sorted(map(str, pii.redact(docs).collect())) == sorted(map(str, docs.collect()))
