import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from outpost.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN, LIB = bpe.WordBpe(bpe.load(PATH)), Tokenizer.from_file(PATH)
PIECES = st.sampled_from(["Hello", "'s", "'LL", " ", "\n\n", "\t", "é", "É", "ß", "×", "12", "<|endoftext|>", "<|", "!!", "Σ", "İ", "́", "\x85", "\x1f", "日本", "a" * 40, "࢏", "'", "thntble"])


def same(texts):
    import pyarrow as pa

    flat, counts = OWN.encoder.batch(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for t, s, e in zip(texts, ends - counts, ends, strict=True):
        want = LIB.encode(t or "", add_special_tokens=False).ids
        assert flat[s:e].tolist() == want, t
        assert OWN.decode(want) == LIB.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=6))
def test_pieces(texts):
    same(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_text(texts):
    same(texts)


def test_edges():
    same([None, "", " ", "x" * 50_000, "1" * 1000, "a " * 5000])


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, t in texts.items():
        ids = LIB.encode(t, add_special_tokens=False).ids
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_dataframe(spark):
    df = spark.createDataFrame([(1, None, 7), (1, "Hi  there", 8), (2, "", 9)], "doc_id int, text string, ids int")
    out = bpe.encode(df, PATH)
    assert [r.ids for r in out.collect()] == [[], LIB.encode("hi there", add_special_tokens=False).ids, []]
    assert [r.decoded for r in bpe.decode(out, PATH).collect()][1] == "hi</w> there</w>"
    assert bpe.encode(df.limit(0), PATH).collect() == [] == bpe.digests(df.limit(0), PATH).collect()
