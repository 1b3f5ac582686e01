"""Token ids as Parquet list columns.

Documents are range-partitioned by id, so that files follow one another in ascending order. Each row holds
the document's ids and, beside them, its place in the file's stream of ids; a file's own place follows from
the sums of the files before it, which come from the two narrow columns alone. Ids are dictionary-encoded
(two bytes or less each), ids of documents and places are delta-encoded, row groups and pages have stated
sizes, and page indexes come with them: a reader that wants a range of documents, or only the figures, skips
the pages and columns it doesn't need.

The texts are shuffled once, by range; ids never are. A task holds one Arrow batch beside Spark's sort.

Defined results. A null or empty text has the end id alone. Repeated ids are separate rows, in the order of
their texts' hashes; a null id comes first. Very many rows of one id, or without one, are spread by these hashes.
A very long text is encoded alone, and its ids are one row. Other columns are not written. No rows: no ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from outpost.llm.bpe import load
from outpost.llm.pretokens import Encoder, chunks
from outpost.llm.store import shared_dir, small_batches
from outpost.operators.joins import lookup_join

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10

#: Words encoded in one call.
LINES = 2000

_SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_str(definition)
    t.no_truncation()
    t.no_padding()

    # the file's own vocabulary and merges behind a split at line ends: words come already cut, one a line
    lines_only = Tokenizer(t.model)
    lines_only.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    end_of_line = lines_only.encode("\n").ids

    def new_words(words: list[bytes]) -> list[bytes]:
        out = [b""] * len(words)
        lines = [i for i, w in enumerate(words) if b"\n" not in w] if len(end_of_line) == 1 else []
        for k in range(0, len(lines), LINES):
            part = lines[k : k + LINES]
            text = b"\n".join([words[i] for i in part]).decode() + "\n"
            ids = np.array(lines_only.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends, raw, s = (4 * np.flatnonzero(ids == end_of_line[0])).tolist(), ids.tobytes(), 0
            for i, e in zip(part, ends, strict=True):
                out[i] = raw[s:e]
                s = e + 4
        for i, w in enumerate(words):
            if w and not out[i]:
                out[i] = np.array(t.encode(w.decode(), add_special_tokens=False).ids, np.uint32).tobytes()
        return out

    special = tuple(a.content.encode() for a in t.get_added_tokens_decoder().values())
    return Encoder(new_words, lambda text: t.encode(text, add_special_tokens=False).ids, True, special)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, row_group: int = ROW_GROUP_BYTES, page: int = PAGE_BYTES) -> None:
    """Write ``docs(doc_id, text)`` as token files under ``path``. tokenizer: path of a byte-level tokenizer's file."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = _encoder(shared.value), TaskContext.get().partitionId(), 0
        for b in (b.slice(s, e - s) for b in batches for s, e in chunks(b.column("text"))):
            flat, counts = encoder.batch(b.column("text"))
            ends = np.cumsum(counts)
            flat = np.insert(flat, ends, end_id).astype(np.int32)
            counts = counts + 1
            ends = np.cumsum(counts)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat))
            columns = [b.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(done + ends - counts), pa.array(counts.astype(np.int32)), ids]
            done += len(flat)
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "part_start", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = ("doc_id", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _SCHEMA)
    options = {"parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(row_group), "parquet.page.size": str(page), "parquet.enable.dictionary": "true"}
    options |= {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part_start", "n_tokens")}
    rows.write.options(**options).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of token files; ``start`` counts all ids before the document's."""
    rows = spark.read.schema(_SCHEMA).parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("long").alias("__before"))
    placed = lookup_join(rows, parts, ["part"])
    return placed.select("doc_id", (F.col("__before") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read`` gives, counted from the ids themselves."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            offsets = ids.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4", copy=False))).cast("B")
            crc = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def files(spark: SparkSession) -> str:
    """A new folder for token files beside the session's checkpoints."""
    return f"{shared_dir(spark)}/outpost-tokens-{uuid.uuid4().hex}"
