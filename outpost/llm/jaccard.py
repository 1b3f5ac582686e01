"""Set similarity self-join on word shingles: a size-aware light and heavy join.

Sets that are equal form one class, and classes are joined. A class can only have a partner if at least the
threshold's share of its shingles occurs in another class, so all shingles are counted first; only classes
that pass go on. Their shingles are put in one order, rare first. Two sets that are similar enough then share
their first ``k`` common shingles within short prefixes. In such a pair the smaller set must have more of its
shingles in common, so a shorter prefix is enough for it, and two sets meet only where a key is in the shorter
prefix of one of them. For ``k`` of 2 and 1:

* light sets, of at most ``boundary`` shingles, are enumerated: each pair of shingles of its prefix is a
  key, and two light sets meet under an equal pair;
* heavy sets scan inverted lists: each shingle of the prefix is a key. Light sets large enough to be similar
  to a heavy set stand in these lists too.

The boundary is the size at which enumerating pairs starts to cost more than the list entries that single
shingles would make one scan, from sums over all candidates.

Under a key, no pairs are listed that can't change the result: in each of a few rounds every set is checked
against the pivots of its keys, and connected sets are merged; what remains are pairs of different components,
which are all checked. A bitmap of each set bounds the difference from below and rejects most pairs before
their shingles are fetched. Whatever is decided is decided on the whole sets.

Scale. Counting shingles moves five bytes a shingle: blocks of texts send each part of the hash space the
shingles they hold, once for all copies in the block and once for all sets that share one, and get back how
many of each class's occur elsewhere. No shingle gathers more than one entry a block, of texts here and of
candidate sets when the candidates' shingles are put in order. A key, pivot, set or label that very many rows
have is dealt to several tasks. Nothing is collected but counts, hot keys (a stated number at most) and a
histogram of set sizes in bins. Blocks and parts both grow in number with the input, so a message holds ever
fewer shingles: their number is bounded by that of the shingles, but past some hundred GB it is the larger cost.

Defined results. A null or empty text, or one without words, has no shingles, links with nothing and is its
own component. A text of fewer than five words has its whole sequence as its only shingle. A very long text is
a block of its own, worked on whole. Repeated ids are separate rows; equal texts are linked through their class.
``component_id`` is the smallest id of the component; ids must not be null for that (a null id is ignored in
it). Pairs that tie at the threshold are linked. Sets are told apart by 128 bits made of their shingles' 64-bit
hashes, which rest on no comparison of words. Columns other than the id and the text are not kept.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from outpost.llm.components import components
from outpost.llm.identity import KEYS, identified, row_hash, row_id
from outpost.llm.pretokens import buffers, chunks
from outpost.llm.shingles import shingle_sets
from outpost.llm.store import small_batches, write_table
from outpost.operators.joins import hot_counts, hot_keys, lookup_join, paired, salted_join

THRESHOLD = 80
#: Shingles of one part of the hash space, about.
PART_SHINGLES = 1 << 20
#: Rounds of pivots before all remaining pairs are checked.
ROUNDS = 3
#: Bits of a set's bitmap.
BITMAP_BITS = 1024
#: Texts in a block, at most: places in a block have two bytes.
BLOCK_ROWS = 60_000
SEED = 77

_SETS = "doc_id long, n_shingles long, k1 long, k2 long, hash long"


def _keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 128-bit key of each set (two int64 a row)."""
    ends = np.cumsum(counts)
    raw = memoryview(hashes.view(np.uint8))
    digests = b"".join([xxhash.xxh3_128_digest(raw[8 * s : 8 * e]) for s, e in zip((ends - counts).tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(digests, np.int64).reshape(-1, 2)


def _blocks(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the shingle hashes of their texts and how many each has."""
    for s, e in chunks(b.column("text")):
        for i in range(s, e, BLOCK_ROWS):
            part = b.slice(i, min(e, i + BLOCK_ROWS) - i)
            yield part, *shingle_sets(*buffers(part.column("text")))


def set_keys(docs: DataFrame) -> DataFrame:
    """Number of shingles and key of the set of every row, and the hash that the row is known by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, hashes, counts in _blocks(b):
                keys = _keys(hashes, counts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(np.ascontiguousarray(keys[:, 0])), pa.array(np.ascontiguousarray(keys[:, 1])), part.column("hash")], names=["doc_id", "n_shingles", "k1", "k2", "hash"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("text").alias("hash"), "text").mapInArrow(run, _SETS)


# ------------------------------------------------- which classes may have partners

#: A block's shingles of one part of the hash space: rests of hashes, and runs of one set each (place in the
#: block, length, tag; tag 0: several sets of the block hold them). ``about``: what the block knows of its sets.
_MESSAGE = "part int, block long, rest binary, place binary, length binary, tag binary, about binary"
_REPLY = "block long, place binary, found binary, about binary"


def _runs(sorted_ids: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], sorted_ids[1:] != sorted_ids[:-1]))) if len(sorted_ids) else np.zeros(0, np.int64)


def _messages(docs: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for _, hashes, counts in _blocks(b):
                block += 1
                keys = _keys(hashes, counts)
                place = np.repeat(np.arange(len(counts)), counts)
                # one of each set
                _, first = np.unique(keys, axis=0, return_index=True)
                one = np.zeros(len(counts), bool)
                one[first] = True
                one &= counts > 0
                keep = one[place]
                h, place = hashes[keep], place[keep]
                order = np.argsort(h, kind="stable")
                h, place = h[order], place[order]
                starts = _runs(h)
                several = np.diff(np.append(starts, len(h))) > 1
                shared = np.repeat(several, np.diff(np.append(starts, len(h))))
                here = np.bincount(place[shared], minlength=len(counts))
                # alone in the block: asked for; held by several sets: said once
                rest, at = np.concatenate((h[~shared], h[starts[several]])), np.concatenate((place[~shared], np.full(int(several.sum()), BLOCK_ROWS)))
                part = ((rest >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((at, part))
                rest, at, part = (rest[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), at[order], part[order]
                runs = _runs(part * (BLOCK_ROWS + 1) + at)
                length = np.diff(np.append(runs, len(rest))).astype("<u4")
                tags = np.append(keys[:, 0], 0)
                tags[:-1][tags[:-1] == 0] = 1
                tag = tags[np.minimum(at[runs], len(counts))].astype("<i8")
                tag[at[runs] == BLOCK_ROWS] = 0
                of_run = part[runs]
                cut_runs = np.searchsorted(of_run, np.arange(parts + 1))
                cut_rest = np.append(runs, len(rest))[cut_runs]
                known = np.flatnonzero(one)
                about = struct.pack("<I", len(known)) + known.astype("<u2").tobytes() + counts[known].astype("<u4").tobytes() + here[known].astype("<u4").tobytes() + keys[known].astype("<i8").tobytes()
                home = block % parts
                chosen = [p for p in range(parts) if cut_runs[p] < cut_runs[p + 1] or p == home]
                cut = lambda a, edges: [a[edges[p] : edges[p + 1]].tobytes() for p in chosen]  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.array(chosen, pa.int32()), pa.array([block] * len(chosen), pa.int64()), pa.array(cut(rest, cut_rest), pa.binary()),
                    pa.array(cut(at[runs].astype("<u2"), cut_runs), pa.binary()), pa.array(cut(length, cut_runs), pa.binary()), pa.array(cut(tag, cut_runs), pa.binary()),
                    pa.array([about if p == home else b"" for p in chosen], pa.binary()),
                ], names=["part", "block", "rest", "place", "length", "tag", "about"])

    return docs.select("text").mapInArrow(run, _MESSAGE)


def _joined(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows one after another, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype), np.array([len(r) for r in rows], np.int64) // np.dtype(dtype).itemsize


def _found(messages: pa.Table) -> pa.Table:
    """For each run of each message, how many of its shingles other sets hold."""
    rest, _ = _joined(messages["rest"], "<u4")
    tag, per_row = _joined(messages["tag"], "<i8")
    length = _joined(messages["length"], "<u4")[0].astype(np.int64)
    tags = np.repeat(tag, length)
    order = np.argsort(rest, kind="stable")
    s, t = rest[order], tags[order]
    starts = _runs(s)
    if len(starts):
        low, high = np.minimum.reduceat(t, starts), np.maximum.reduceat(t, starts)
        shared = (low != high) | (low == 0)
        hit = np.empty(len(s), np.int64)
        hit[order] = np.repeat(shared, np.diff(np.append(starts, len(s))))
        found = np.add.reduceat(hit, np.cumsum(length) - length).astype("<u4")
    else:
        found = np.zeros(0, "<u4")
    raw, cuts = found.tobytes(), np.concatenate(([0], np.cumsum(per_row))) * 4
    return pa.table({
        "block": messages["block"], "place": messages["place"],
        "found": pa.array([raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.binary()), "about": messages["about"],
    })


def _passing(threshold: int):
    def run(replies: pa.Table) -> pa.Table:
        """Keys of a block's sets of which enough shingles occur elsewhere."""
        about = max(replies["about"].to_pylist(), key=len)
        n = struct.unpack_from("<I", about)[0]
        known = np.frombuffer(about, "<u2", n, 4)
        counts, here = np.frombuffer(about, "<u4", n, 4 + 2 * n).astype(np.int64), np.frombuffer(about, "<u4", n, 4 + 6 * n)
        keys = np.frombuffer(about, "<i8", 2 * n, 4 + 10 * n).reshape(-1, 2)
        place, _ = _joined(replies["place"], "<u2")
        found, _ = _joined(replies["found"], "<u4")
        total = np.bincount(place, found, minlength=BLOCK_ROWS + 1).astype(np.int64)[known] + here
        ok = 100 * total >= threshold * counts
        return pa.table({"k1": np.ascontiguousarray(keys[ok, 0]), "k2": np.ascontiguousarray(keys[ok, 1])})

    return run


def candidate_keys(docs: DataFrame, n_shingles: int, threshold: int) -> DataFrame:
    """``k1, k2`` of the sets that may have a partner, with repeats."""
    parts = max(8, math.ceil(n_shingles / PART_SHINGLES))
    replies = _messages(docs, parts).groupBy("part").applyInArrow(_found, _REPLY)
    return replies.groupBy("block").applyInArrow(_passing(threshold), "k1 long, k2 long")


# ------------------------------------------------- prefixes


def _candidate_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, n, shingles`` of the wanted classes. wanted: ``cid, rep, hash, k1, k2``, id and hash of one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, hashes, counts in _blocks(b):
                keys = _keys(hashes, counts)
                same = (keys[:, 0] == part.column("k1").to_numpy()) & (keys[:, 1] == part.column("k2").to_numpy())
                cuts = np.concatenate(([0], np.cumsum(counts))) * 8
                raw = hashes.astype("<u8").tobytes()
                at = np.flatnonzero(same)
                yield pa.RecordBatch.from_arrays([part.column("cid").take(pa.array(at)), pa.array(counts[at].astype(np.int64)), pa.array([raw[cuts[i] : cuts[i + 1]] for i in at.tolist()], pa.binary())], names=["cid", "n", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), row_hash("text").alias("hash"), "text")
    rows = lookup_join(rows, wanted, ["rep", "hash"])
    return rows.select("cid", "k1", "k2", "text").mapInArrow(run, "cid long, n long, shingles binary").dropDuplicates(["cid"])


def _different(sets: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of a block's sets, ordered by part of the hash space: how many sets of the block hold
    each, and edges of the parts. Also the place of each set's shingles among them, and how many each has."""
    hashes, per_set = _joined(sets["shingles"], "<u8")
    part = (hashes >> np.uint64(32)) % np.uint64(parts)
    # what tells a shingle from others of its part is the low half of its hash
    _, first, inverse, n = np.unique(part << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF), return_index=True, return_inverse=True, return_counts=True)
    return hashes[first], n, np.searchsorted(part[first], np.arange(parts + 1)), inverse, per_set


def _ask_counts(parts: int):
    def run(sets: pa.Table) -> pa.Table:
        """A block's shingles by part of the hash space, each once with how many sets of the block hold it."""
        different, n, edges, _, _ = _different(sets, parts)
        chosen = np.flatnonzero(np.diff(edges)).tolist()
        cut = lambda x: pa.array([x[edges[p] : edges[p + 1]].tobytes() for p in chosen], pa.binary())
        rest = (different & np.uint64(0xFFFFFFFF)).astype("<u4")
        return pa.table({"part": pa.array(chosen, pa.int32()), "block": pa.array([sets["block"][0].as_py()] * len(chosen), pa.int64()), "rest": cut(rest), "held": cut(n.astype("<u4"))})

    return run


def _count(messages: pa.Table) -> pa.Table:
    """How many sets hold each shingle of each message, up to 65535."""
    rest, per_row = _joined(messages["rest"], "<u4")
    held, _ = _joined(messages["held"], "<u4")
    _, inverse = np.unique(rest, return_inverse=True)
    n = np.bincount(inverse, held)
    raw, cuts = np.minimum(n, 65535)[inverse].astype("<u2").tobytes(), (2 * np.concatenate(([0], np.cumsum(per_row)))).tolist()
    return pa.table({"part": messages["part"], "block": messages["block"], "counts": pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def bitmap(hashes: np.ndarray) -> bytes:
    """Parities of the hashes in ``BITMAP_BITS`` classes: two sets differ in at least as many elements as their
    bitmaps differ in bits."""
    odd = np.bincount((hashes % np.uint64(BITMAP_BITS)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


_PREFIXES = "cid long, n long, misses long, bits array<long>, prefix array<long>, counts array<int>"


def _prefix(parts: int, threshold: int):
    def run(sets: pa.Table, counts: pa.Table) -> pa.Table:
        """Rare shingles first: the prefix of each set, without those that no other set holds."""
        hashes = _joined(sets["shingles"], "<u8")[0]
        _, _, _, inverse, per_set = _different(sets, parts)
        answers = dict(zip(counts["part"].to_pylist(), counts["counts"].to_pylist(), strict=True))
        df = np.frombuffer(b"".join([answers[p] for p in sorted(answers)]), "<u2").astype(np.int64)[inverse]
        out: dict[str, list] = {k: [] for k in ("cid", "n", "misses", "bits", "prefix", "counts")}
        end = np.cumsum(per_set)
        for cid, s, e in zip(sets["cid"].to_pylist(), (end - per_set).tolist(), end.tolist(), strict=True):
            h, d = hashes[s:e], df[s:e]
            n = e - s
            alone = int((d < 2).sum())
            misses = n - -(-threshold * n // 100) - alone
            if misses < 0:
                continue
            common = d >= 2
            h, d = h[common], d[common]
            first = np.lexsort((h, d))[: misses + 2]
            out["cid"].append(cid)
            out["n"].append(n)
            out["misses"].append(misses)
            out["bits"].append(np.frombuffer(bitmap(hashes[s:e]), "<i8"))
            out["prefix"].append(h[first].view(np.int64))
            out["counts"].append(d[first].astype(np.int32))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def prefixes(sets: DataFrame, n_shingles: int, threshold: int) -> DataFrame:
    """Prefixes of the candidate sets ``cid, n, shingles``, with the room for misses that each has left."""
    parts = max(8, math.ceil(n_shingles / PART_SHINGLES))
    blocks = max(8, math.ceil(n_shingles / PART_SHINGLES))
    s = sets.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "cid"), F.lit(blocks)))
    asked = s.select("block", "cid", "shingles").groupBy("block").applyInArrow(_ask_counts(parts), "part int, block long, rest binary, held binary")
    counts = asked.groupBy("part").applyInArrow(_count, "part int, block long, counts binary")
    return s.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_prefix(parts, threshold), _PREFIXES)


def boundary_of(p: DataFrame, rounds: int = ROUNDS) -> int:
    """The set size up to which enumerating pairs of shingles costs no more than scanning lists would, summed
    over all sets of a bin of sizes; bins grow by a quarter, so there are few. A list is scanned for as many
    partners as it has, but no more than there are rounds of pivots and one."""
    m = F.col("misses")
    bin_of = F.floor(F.log(F.col("n").cast("double")) / math.log(1.25))
    scanned = F.aggregate(F.slice("counts", 1, (m + 1).cast("int")), F.lit(0.0), lambda a, c: a + F.least(c, F.lit(rounds + 1)))
    costs = p.groupBy(bin_of.alias("bin")).agg(F.max("n").alias("n"), F.sum((m + 2) * (m + 1) / 2).alias("light"), F.sum(scanned).alias("heavy"))
    rows = sorted(costs.collect(), key=lambda r: r["n"])  # a row per bin, about a hundred at most
    best, boundary, total = 0.0, 0, 0.0
    for r in rows:
        total += r["light"] - r["heavy"]
        if total <= best:
            best, boundary = total, r["n"]
    return boundary


def keys(p: DataFrame, boundary: int, threshold: int) -> DataFrame:
    """``key, cid, n, misses, most``: pairs of prefix shingles of light sets, single ones of heavy sets and of
    those light sets that may be similar to a heavy one.

    ``most`` is the largest size of a partner under the key, if the key holds the first shingles in common:
    ``t (n + n') / (100 + t)`` shingles must be common, and none before the key's last can be one but the
    key's own. A pair counts under a key if each is within the other's ``most``; its first key is always one."""
    m = F.col("misses").cast("int")
    shared = F.col("misses") + F.ceil(F.col("n") * threshold / F.lit(100))
    most = lambda skipped: F.floor((shared - skipped) * (100 + threshold) / F.lit(threshold)).cast("long") - F.col("n")
    key = lambda h, skipped: F.struct(h.alias("key"), most(skipped).alias("most"))
    two, rest = F.slice("prefix", 1, m + 2), lambda i: F.slice("prefix", i + 2, F.greatest(m + 1 - i, F.lit(0)))
    pairs = F.flatten(F.transform(two, lambda x, i: F.transform(rest(i), lambda y, j: key(F.xxhash64(F.lit(2), x, y), i + j))))
    ones = F.transform(F.slice("prefix", 1, m + 1), lambda x, i: key(F.xxhash64(F.lit(1), x), i))
    light = p.where(F.col("n") <= boundary).select(F.explode(pairs).alias("k"), "cid", "n", "misses")
    heavy = p.where(100 * F.col("n") > threshold * boundary).select(F.explode(ones).alias("k"), "cid", "n", "misses")
    return light.unionByName(heavy).select("k.key", "cid", "n", "misses", "k.most")


# ------------------------------------------------- checking


def _with_both(pairs: DataFrame, side, hot: tuple[DataFrame | None, DataFrame | None]) -> DataFrame:
    """Pairs with the columns of both their sets; a pivot's very many pairs in several tasks."""
    return salted_join(salted_join(pairs, side("a"), ["a"], ["b"], hot[0]), side("b"), ["b"], ["a"], hot[1])


def plausible(pairs: DataFrame, p: DataFrame, threshold: int, hot: tuple[DataFrame | None, DataFrame | None] = (None, None)) -> DataFrame:
    """Pairs ``a, b`` whose sizes and bitmaps allow the threshold, with both sizes."""
    side = lambda s: p.select(F.col("cid").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits{s}"))
    j = _with_both(pairs, side, hot)
    differ = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)
    total = F.col("na") + F.col("nb")
    # |A xor B| = |A| + |B| - 2 |A and B|, and the overlap must be at least t / (100 + t) of |A| + |B|
    room = differ * (100 + threshold) <= total * (100 - threshold)
    sizes = (100 * F.col("na") >= threshold * F.col("nb")) & (100 * F.col("nb") >= threshold * F.col("na"))
    return j.where(sizes & room).select("a", "b", "na", "nb")


def _overlaps(pairs: pa.RecordBatch) -> np.ndarray:
    a, b = pairs.column("sa").to_pylist(), pairs.column("sb").to_pylist()
    return np.array([len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)


def verified(pairs: DataFrame, sets: DataFrame, threshold: int, hot: tuple[DataFrame | None, DataFrame | None] = (None, None)) -> DataFrame:
    """``a, b, ok`` by the overlap of the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n = _overlaps(x)
            ok = 100 * n >= threshold * (x.column("na").to_numpy() + x.column("nb").to_numpy() - n)
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b"), pa.array(ok)], names=["a", "b", "ok"])

    side = lambda s: sets.select(F.col("cid").alias(s), F.col("shingles").alias(f"s{s}"))
    both = _with_both(pairs, side, hot).select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a long, b long, ok boolean")


def linked(p: DataFrame, sets: DataFrame, k: DataFrame, threshold: int, rounds: int = ROUNDS) -> DataFrame:
    """``id, label`` of every candidate class with a partner. Keys whose sets are all of one component are
    done with. The pivot of a key is the set of which most shingles occur elsewhere: the original of a group
    of edited copies, if it is there, which all of them are like even where no two of them are."""
    empty = p.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0)
    tried, edges, labels = empty, empty, None
    lists = k.withColumn("label", F.col("cid"))

    def counts(x: str, y: str):
        """Whether the pair of sets with these column endings counts under its key."""
        n, m, most, best = F.col(f"n{x}"), F.col(f"n{y}"), F.col(f"most{x}"), F.col(f"most{y}")
        return (m <= most) & (n <= best) & (100 * n >= threshold * m) & (100 * m >= threshold * n)

    for r in range(rounds + 1):
        rank = F.when(F.col("most") >= F.col("n"), F.struct(F.col("misses") / F.col("n"), F.xxhash64(F.lit(r), "cid")))
        state = lists.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.max_by(F.struct("cid", "label", "n", "most"), rank).alias("p"), F.max(F.col("most") >= F.col("n")).alias("any"), F.min("n").alias("least"), F.count(F.lit(1)).alias("many"))
        # a pair's smaller set is within its own bound
        state = state.where("l0 <> l1 and any").select("key", "least", "many", F.col("p.cid").alias("pivot"), F.col("p.label").alias("pl"), F.col("p.n").alias("np"), F.col("p.most").alias("mostp"))
        state = write_table(state, "states")
        total = state.agg(F.coalesce(F.sum("many"), F.lit(0)).alias("n")).first()["n"]
        if not total:
            break
        lists = salted_join(lists, state, ["key"], ["cid"], hot_counts(state, ["key"], "many", total)).where("most >= least").drop("least")
        lists = write_table(lists, "lists")
        if r < rounds:
            pairs = lists.where((F.col("label") != F.col("pl")) & counts("", "p")).select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
            todo = pairs.distinct().join(tried, ["a", "b"], "left_anti")
            # a pivot has met all others of its key
            lists = lists.where("cid <> pivot")
        else:
            side = lambda s: [F.col(c).alias(f"{c}{s}") for c in ("cid", "label", "n", "most")]
            x, y = lists.where("most >= n").select("key", "many", *side("x")), lists.select("key", "many", *side("y"))
            fits = (F.col("labelx") != F.col("labely")) & (F.col("nx") <= F.col("ny")) & counts("x", "y")
            met = paired(x, y, "key", "many", ("cidx", "cidy")).where(fits)
            todo = met.select(F.least("cidx", "cidy").alias("a"), F.greatest("cidx", "cidy").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        todo = write_table(todo, "pairs")
        hot = (hot_keys(todo, ["a"]), hot_keys(todo, ["b"]))
        likely = write_table(plausible(todo, p, threshold, hot), "plausible")
        known = write_table(verified(likely, sets, threshold, hot).where("ok").select("a", "b"), "links")
        tried = tried.unionByName(todo)
        lists = lists.drop("pivot", "pl", "np", "mostp", "many")
        if known.isEmpty():
            continue
        edges = edges.unionByName(known)
        labels = write_table(components(edges), "labels")
        now = labels.select(F.col("id").alias("cid"), F.col("label").alias("now"))
        lists = lists.join(now, "cid", "left").withColumn("label", F.coalesce("now", "label")).drop("now")
    return labels if labels is not None else empty.select(F.col("a").alias("id"), F.col("b").alias("label"))


def join(docs: DataFrame, threshold: int = THRESHOLD, rounds: int = ROUNDS, boundary: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    return _joined_rows(docs, threshold, rounds, boundary).select("doc_id", "n_shingles", "component_id")


def _joined_rows(docs: DataFrame, threshold: int, rounds: int = ROUNDS, boundary: int | None = None) -> DataFrame:
    """What ``join`` gives, with the ``hash`` of each row and the ``label`` of its component, null without words."""
    small_batches(docs.sparkSession)
    rows = write_table(set_keys(docs), "sets")
    full = rows.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    classes = full.groupBy("k1", "k2").agg(first, F.first("n_shingles").alias("n"))
    classes = classes.select("k1", "k2", "n", F.col("first.doc_id").alias("rep"), "first.hash", F.monotonically_increasing_id().alias("cid"))
    classes = write_table(classes, "classes")
    total = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    wanted = candidate_keys(docs, total, threshold).distinct().join(classes, ["k1", "k2"])
    wanted = write_table(wanted.select("cid", "rep", "hash", "k1", "k2", "n"), "wanted")
    some = wanted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = None
    if some:
        sets = write_table(_candidate_sets(docs, wanted.drop("n")), "shingles")
        p = write_table(prefixes(sets, some, threshold), "prefixes")
        k = write_table(keys(p, boundary_of(p) if boundary is None else boundary, threshold), "keys")
        labels = linked(p, sets, k, threshold, rounds)
        hot = hot_keys(labels, ["label"])
        classes = classes.join(labels.select(F.col("id").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    else:
        classes = classes.withColumn("label", F.col("cid"))
    least = classes.groupBy("label").agg(F.min("rep").alias("component_id"))
    classes = write_table(salted_join(classes, least, ["label"], ["cid"], hot).select("k1", "k2", "component_id", "label"), "components")
    found = salted_join(full, classes, ["k1", "k2"], ["doc_id", "hash"], hot_keys(full, ["k1", "k2"])).select("doc_id", "n_shingles", "component_id", "hash", "label")
    return found.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "hash", F.lit(None).cast("long").alias("label")))


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component, that with the smallest id, null last, then by the hash of its text; all
    columns stay. Rows without words all stay, but of rows equal in id and text one does."""
    rows = _joined_rows(docs.select("doc_id", "text"), threshold)
    known = F.struct(F.col("doc_id").isNull().alias("last"), row_id().alias("id"), F.col("hash"))
    alone = F.when(F.col("label").isNull(), known).alias("alone")
    kept = rows.groupBy("label", alone).agg(F.min(known).alias("first")).select("first.id", "first.hash")
    return identified(docs, "text").join(write_table(kept, "kept"), KEYS, "left_semi").dropDuplicates(KEYS).select("row.*")
