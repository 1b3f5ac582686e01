import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings, strategies as st
from outpost.llm import bpe, tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
OWN, LIB = tokens._encoder(bpe.load(PATH)), Tokenizer.from_file(PATH)
PIECES = st.sampled_from(["Hello", "'s", " ", "  ", "\n\n", "\t", "\r\n", "é", "É", "×", "12", "<|endoftext|>", "!!", "|", "\x85", "\x1f", "\xa0", "日本", "'", "the"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=6))
def test_words(texts):
    flat, counts = OWN.batch(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for t, s, e in zip(texts, ends - counts, ends, strict=True):
        assert flat[s:e].tolist() == LIB.encode(t, add_special_tokens=False).ids, t


def brute(rows):
    start = 0
    for k, t in sorted(rows):
        ids = [*LIB.encode(t or "", add_special_tokens=False).ids, 2]
        yield k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def written(spark, df):
    path = tokens.files(spark)
    tokens.write(df, path, PATH)
    return path, sorted(tuple(r) for r in tokens.checksums(tokens.read(spark, path)).collect())


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    path, got = written(spark, docs)
    assert got == list(brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_edges(spark):
    df = spark.createDataFrame([(5, "", "a"), (1, "one two", "b"), (5, "", "c"), (7, None, "d"), (3, "x " * 40_000, "e")], "doc_id int, text string, ids string")
    _, got = written(spark, df)
    assert got == list(brute([(r.doc_id, r.text or "") for r in df.collect()]))
    assert written(spark, df.limit(0))[1] == []


def test_file_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tokens.write(docs, f"file://{tmp_path}/t", PATH, row_group=1 << 18, page=1 << 14)
    files = sorted(tmp_path.glob("t/*.parquet"))
    meta = [pq.ParquetFile(f).metadata for f in files]
    column = {m.row_group(0).column(i).path_in_schema: m.row_group(0).column(i) for m in meta for i in range(m.row_group(0).num_columns)}
    assert any("DICT" in e for e in column["ids.list.element"].encodings)
    assert column["doc_id"].encodings and "DELTA_BINARY_PACKED" in column["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in column.values())
    plan = tokens.read(spark, f"file://{tmp_path}/t").where("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("== Physical Plan ==")[1].split("ReadSchema")[1][:120]
