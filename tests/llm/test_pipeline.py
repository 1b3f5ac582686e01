import hashlib
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
from outpost.llm import pii
from test_mixing import in_order
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def staged(spark, tmp, sf=SF):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"file://{tmp}/{k}")
        before, docs = docs, spark.read.parquet(f"file://{tmp}/{k}")
        out.append((before.collect(), docs.collect(), before.columns, docs.columns))
    return out


def test_stages(spark, tmp_path):
    stages = staged(spark, tmp_path)
    for _, _, before, after in stages[:-1]:
        assert before == after
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    before, after, _, _ = stages[0]
    kept = {r.doc_id for r in after}
    good = [k for k, q in labels.items() if q == 1]
    assert sum(k in kept for k in good) > 0.95 * len(good)
    assert sum(k not in kept for k, q in labels.items() if q == 0) > 0.8 * sum(q == 0 for q in labels.values())
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)

    before, after, _, _ = stages[1]
    sets = {r.doc_id: frozenset(zip(*[WORD.findall(r.text.lower())[i:] for i in range(5)])) for r in before}
    left = {r.doc_id for r in after}
    assert len(left) == len(after)
    for a in left:
        for b in left:
            if a < b:
                n = len(sets[a] & sets[b])
                assert 100 * n < 80 * len(sets[a] | sets[b])
    assert len(left) > 0.85 * len(before)

    before, after, _, _ = stages[2]
    texts = {r.doc_id: r.text for r in after}
    assert all(texts[r.doc_id] == pii._masked(r.text, pii.spans(r.text)) for r in before)
    assert not any(s[0] == "email" for t in texts.values() for s in pii.spans(t))

    before, after, _, _ = stages[3]
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] or in_order(WORD.findall(r.text), WORD.findall(texts[r.doc_id])) for r in after)
    words = lambda rows: Counter({s: 0 for s in {r.source for r in rows}}) + sum((Counter({r.source: len(WORD.findall(r.text))}) for r in rows), Counter())
    old, new = words(before), words(after)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(old))}
    total = sum(old.values())
    for s in old:
        share = total * weights[s] / sum(weights.values())
        if share < 3 * old[s]:
            assert abs(new[s] - share) < 0.05 * share + 200
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 4

    before, after, _, _ = stages[4]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before:
        ids = lib.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, tuple(ids), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert want == Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in after)
    assert corpus_pipeline.run(spark, SF).count() == len(after)
