"""BPE encoding and decoding with a given vocabulary.

A word starts as a doubly linked list of symbols. A priority queue holds the merges that neighbours allow, by
rank, then place; popping one whose symbols have changed since is skipped. Merging links the joined symbol in
and queues its two new neighbours. Decoding joins the vocabulary strings of the ids.

Works inside tasks on one Arrow batch at a time, no shuffle; different words of a batch are encoded once and
the recent ones are kept, in bounded number. The vocabulary file is shipped to the executors by value.

Defined results. A null or empty text has no ids and decodes to an empty text. Repeated ids are separate
rows. Very long words take ``n log n`` time. Other columns are kept by ``encode`` unless they have the name
of its result, which replaces them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from outpost.llm.pretokens import Encoder, chunks
from outpost.llm.store import small_batches

#: How the tokenizer's file cuts words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPACES = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that print in
    Latin-1 stand for themselves, the others for the code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A tokenizer read from its JSON file: lower case, white space dropped, words with an end mark."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        d = json.loads(definition)
        model = d["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.added).items()}
        self.symbols = byte_symbols()
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        own = Tokenizer.from_str(definition)
        self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
        self.known: set[str] = set()
        self.encoder = Encoder(lambda ws: [array('I', self.word(w)).tobytes() for w in ws], self.odd_text, False, tuple(s.encode() for s in self.added), slots=1 << 18)

    def word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        symbols = [self.symbols[b] for b in word]
        return self.merged(symbols)

    def merged(self, symbols: list[str]) -> list[int]:
        if not symbols:
            return []
        symbols[-1] += self.end
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        queue = [(r, i, i + 1) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(queue)
        alive: list[str | None] = symbols
        while queue:
            r, i, j = heapq.heappop(queue)
            a = alive[i]
            if a is None or right[i] != j or ranks.get((a, alive[j])) != r:
                continue  # stale: one of the two has been merged since
            alive[i], alive[j] = a + alive[j], None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (x := ranks.get((alive[i], alive[k]))) is not None:
                    heapq.heappush(queue, (x, i, k))
            h = left[i]
            if h >= 0 and (x := ranks.get((alive[h], alive[i]))) is not None:
                heapq.heappush(queue, (x, h, i))
        out, i, vocab = [], 0, self.vocab
        while i < n:
            if (x := vocab.get(alive[i])) is not None:
                out.append(x)
            i = right[i]
        return out

    def _words(self, text: str) -> list[str]:
        new = set(text) - self.known
        if any(unicodedata.category(c) == "Cn" for c in new):
            # code points newer than Python's tables: the file's own normaliser and splitter know them
            return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        self.known |= new
        text = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
        # letter by letter: a final sigma is lowered as any other
        text = text.replace("Σ", "σ").lower()
        return ["".join(self.symbols[b] for b in w.encode()) for w in WORDS.findall(text)]

    def odd_text(self, text: str) -> list[int]:
        out: list[int] = []
        done = 0
        for m in self.special.finditer(text) if self.special else ():
            out += [i for w in self._words(text[done : m.start()]) for i in self.merged(list(w))]
            out.append(self.added[m[0]])
            done = m.end()
        return out + [i for w in self._words(text[done:]) for i in self.merged(list(w))]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings, with a blank between them."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=2)
def _loaded(definition: str) -> WordBpe:
    return WordBpe(definition)


def load(path: str) -> str:
    """The tokenizer's definition, read on the driver (a file of a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer: str, column: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in ``column`` (array of int). tokenizer: path of the JSON file."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    kept = [c for c in docs.columns if c.lower() != column.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(column, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for b in (b.slice(s, e - s) for b in batches for s, e in chunks(b.column("text"))):
            flat, counts = bpe.encoder.batch(b.column("text"))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))], names=[*b.schema.names, column])

    return docs.select(*kept).mapInArrow(run, schema)


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, and decoded again, in one pass."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for b in (b.slice(s, e - s) for b in batches for s, e in chunks(b.column("text"))):
            flat, counts = bpe.encoder.batch(b.column("text"))
            ends = np.cumsum(counts)
            of_ids, of_text = [], []
            for s, e in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                ids = flat[s:e]
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DIGESTS)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids`` in ``column``; null ids give null."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(load(tokenizer))
    kept = [c for c in rows.columns if c.lower() != column.lower()]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for b in batches:
            texts = [None if x is None else bpe.decode(x) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, column])

    return rows.select(*kept).mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``, ``ids`` and the digest of the text decoded from them."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    kept = [c for c in docs.columns if c.lower() not in {"text", "n_tokens", "ids", "decoded_sha256"}]
    added = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for b in (b.slice(s, e - s) for b in batches for s, e in chunks(b.column("text"))):
            flat, counts = bpe.encoder.batch(b.column("text"))
            ends = np.cumsum(counts)
            digests = [hashlib.sha256(bpe.decode(flat[s:e].tolist()).encode()).hexdigest() for s, e in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(counts, pa.int64()), ids, pa.array(digests, pa.string())], names=[*kept, *added.names])

    return docs.select(*kept, "text").mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + added.fields))
