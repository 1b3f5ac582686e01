"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id. All suffixes
of all texts can't be sorted in one place, so suffixes that can be equal in their first ``LENGTH`` bytes are
brought together: each window of that length is filed under its anchor, the ``ANCHOR``-byte string in it with
the smallest hash, which depends on nothing but the window. Windows in a row mostly have the same anchor, so
an anchor occurrence stands for a run of windows.

1. Blocks of texts tell each part of the hash space which anchors they hold, and learn which of them occur
   in other documents too. The rest can't be repeated and goes no further.
2. For those anchors blocks send the bytes that their windows cover (each different stretch once a block,
   with the smallest id that has it; windows of anchors that many blocks hold are filed under the smallest
   hash beside the anchor's own as well, so that no anchor gathers all its surroundings). Each part of the hash space sorts the suffixes at all window starts
   among suffixes of the same anchor and place: a mergesort whose comparisons find the common extension of
   two suffixes by binary search over prefix polynomial hashes, and then look at one byte. Neighbours that
   agree in ``LENGTH`` bytes by their hashes are compared byte by byte, so that a collision can't remove
   anything. The smallest id of each set of equal windows goes back to the blocks.
3. Blocks mark, count and digest.

Blocks are written once, as a table in the warehouse bucketed by block, so that answers come to the texts
and texts are not shuffled. No part gets more than one entry a block for an anchor, or for a stretch, however
often it occurs; nothing is collected.

Defined results. A null or empty text has no bytes and nothing is removed. Repeated ids are separate rows;
none of them is smaller than the other. A null id is larger than all others. Strings that repeat within one
document alone stay. Other columns are not kept. A row is worked on whole, at some forty times its size in
memory.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from outpost.llm.pretokens import buffers, chunks
from outpost.llm.shingles import mix, powers
from outpost.llm.store import small_batches, write_table

LENGTH = 50
ANCHOR = 24
#: An anchor held by so many blocks may have very many surroundings; its windows are filed by a second one too.
COMMON_BLOCKS = 32
#: Bytes of a block worked on at once.
PIECE = 1 << 18
#: Bytes of text for which there is one part of the hash space, and one bucket.
PART_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
NONE = np.iinfo(np.int64).max
SEVERAL = np.iinfo(np.int64).min

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Prefixes:
    """Prefix polynomial hashes of a byte string (mod 2**64)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.up, self.down = powers(n + 1)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTE[data] * self.up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the strings that start there."""
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


class Anchors:
    """Anchor occurrences of a block: ``first`` window start, how ``many`` windows, place ``at`` of the
    anchor, its ``hash``, a hash ``stretch`` of all bytes of its windows, and the text ``doc`` it is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        # pieces of whole texts that fit the processor's cache
        cuts = np.unique(np.searchsorted(offsets, np.arange(0, len(data) + PIECE, PIECE)).clip(0, len(offsets) - 1))
        found = [_anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], int(offsets[i]), i) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if offsets[j] > offsets[i]]
        none = np.zeros(0, np.int64)
        empty = (none, none, none, none.astype(np.uint64), none.astype(np.uint64), none)
        self.first, self.many, self.at, self.hash, self.stretch, self.doc = (np.concatenate(x) for x in zip(empty, *found, strict=True))


def _anchors(data: np.ndarray, offsets: np.ndarray, base: int, base_doc: int) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, np.int64)
    lengths = np.diff(offsets) - (LENGTH - 1)
    fit = np.flatnonzero(lengths > 0)
    if not len(fit):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    prefixes = Prefixes(data)
    h = prefixes.sums[ANCHOR:] - prefixes.sums[:-ANCHOR]
    h *= prefixes.down[: len(h)]
    h = mix(h)
    low = h & ~np.uint64(0xFFFFFFFF)
    low |= np.arange(len(h), dtype=np.uint64)
    need, span = LENGTH - ANCHOR + 1, 1
    while span * 2 <= need:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if need > span:
        low = np.minimum(low[: len(low) - (need - span)], low[need - span :])
    window = _spread(offsets[fit], lengths[fit])
    at = low[window] if len(window) < len(low) else low
    heads = np.cumsum(lengths[fit]) - lengths[fit]
    new = np.empty(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=new[1:])
    new[heads] = True
    runs = np.flatnonzero(new)
    first, at = window[runs], (at[runs] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    many = np.diff(np.append(runs, len(window)))
    size = many + (LENGTH - 1)
    stretch = mix(prefixes.of(first, size) + _shape(size, at - first))
    # the smallest of many hashes is small: mixed again, so that anchors spread evenly over the parts
    return first + base, many, at + base, mix(h[at]), stretch, np.searchsorted(offsets, first, "right") - 1 + base_doc


def _shape(size: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of a stretch's size and its anchor's place in it."""
    return (size.astype(np.uint64) << np.uint64(8) | place.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``start, start + 1, …`` for each start."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash space; ascending hashes are in ascending parts."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _cut(values: np.ndarray, edges: np.ndarray, chosen: list[int]) -> list[bytes]:
    return [values[edges[p] : edges[p + 1]].tobytes() for p in chosen]


class Block:
    """Texts of a block and what it asks about them."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.sizes = np.frombuffer(sizes, "<i8")
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self.data = np.frombuffer(text, np.uint8)
        self.anchors = Anchors(self.data, self.offsets)

    def questions(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different anchor hashes in the order they are sent, the id of the one document that has each (or
        ``SEVERAL``), edges of the parts, and for each anchor occurrence its place among the hashes."""
        h = self.anchors.hash
        order = np.argsort(h)
        runs = _runs(h[order])
        ids = self.ids[self.anchors.doc[order]]
        low, high = (np.minimum.reduceat(ids, runs), np.maximum.reduceat(ids, runs)) if len(runs) else (ids, ids)
        different = h[order][runs]
        where = np.empty(len(h), np.int64)
        where[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(h))))
        edges = np.searchsorted(_part(different, parts), np.arange(parts + 1))
        return different, np.where(low == high, low, SEVERAL), edges, where

    def occurrences(self, repeated: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of windows to be sorted: first window, how many, place of the anchor, the hash they are filed
        under, hash of their bytes, text. Those of anchors with very many surroundings are cut further, by the
        smallest hash beside the anchor's own."""
        a = self.anchors
        at = np.flatnonzero(repeated & ~common)
        plain = [x[at] for x in (a.first, a.many, a.at, a.hash, a.stretch, a.doc)]
        at = np.flatnonzero(repeated & common)
        if not len(at):
            return tuple(plain)
        prefixes = Prefixes(self.data)
        window, of = _spread(a.first[at], a.many[at]), np.repeat(at, a.many[at])
        own = mix(prefixes.of(a.at[of], ANCHOR))
        second = np.full(len(window), np.iinfo(np.uint64).max, np.uint64)
        for k in range(LENGTH - ANCHOR + 1):
            h = mix(prefixes.of(window + k, ANCHOR))
            np.minimum(second, h, out=second, where=h != own)
        runs = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (second[1:] != second[:-1]))))
        first, of = window[runs], of[runs]
        many = np.diff(np.append(runs, len(window)))
        filed = mix(a.hash[of] + second[runs] * np.uint64(0x9FB21C651E98DF25))
        size = many + (LENGTH - 1)
        stretch = mix(prefixes.of(first, size) + _shape(size, a.at[of] - first))
        return tuple(np.concatenate(x) for x in zip(plain, (first, many, a.at[of], filed, stretch, a.doc[of]), strict=True))

    def stretches(self, runs_of: tuple[np.ndarray, ...], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different stretches of bytes, ordered by part: place of one occurrence of each, smallest id that
        has it, edges of the parts; and each occurrence's stretch."""
        first, many, at, filed, key, doc = runs_of
        part = _part(filed, parts)
        order = np.lexsort((key, part))
        new = np.ones(len(key), bool)
        near = np.flatnonzero((key[order][1:] == key[order][:-1]) & (part[order][1:] == part[order][:-1]))
        # neighbours with equal hashes are one stretch if their bytes are equal
        x, y = order[near], order[near + 1]
        size = many + (LENGTH - 1)
        alike = (many[x] == many[y]) & ((at - first)[x] == (at - first)[y])
        new[1:][near] = ~(alike & equal_bytes(self.data, first[x], first[y], np.minimum(size[x], size[y])))
        runs = np.flatnonzero(new)
        one = order[runs]
        ids = self.ids[doc[order]]
        least = np.minimum.reduceat(ids, runs) if len(runs) else ids
        where = np.empty(len(key), np.int64)
        where[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(key))))
        return one, least, np.searchsorted(part[one], np.arange(parts + 1)), where


# ------------------------------------------------- which anchors are repeated

_ASK = "part int, block long, rest binary, ids binary, runs binary"
_TOLD = "block long, part int, bits binary, common binary"


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block(row["ids"], row["sizes"], row["text"])
                h, ids, edges, _ = block.questions(parts)
                part = np.repeat(np.arange(parts), np.diff(edges))
                # within a part by id, so that an id is sent once; the block sorts alike when it is told
                order = _by_part(part, ids)
                ids, rest = ids[order], (h[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
                starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (part[1:] != part[:-1])))) if len(ids) else np.zeros(0, np.int64)
                n = np.diff(np.append(starts, len(ids))).astype("<u4")
                run_edges = np.searchsorted(part[starts], np.arange(parts + 1))
                chosen = np.flatnonzero(np.diff(edges)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.int32()), pa.array([row["block"]] * len(chosen), pa.int64()), pa.array(_cut(rest, edges, chosen), pa.binary()), pa.array(_cut(ids[starts].astype("<i8"), run_edges, chosen), pa.binary()), pa.array(_cut(n, run_edges, chosen), pa.binary())], names=["part", "block", "rest", "ids", "runs"])

    return run


def _by_part(part: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Order by part, then id."""
    _, place = np.unique(ids, return_inverse=True)
    return np.argsort(part * (len(ids) + 1) + place, kind="stable")


def _tell(common_blocks: int):
    def run(messages: pa.Table) -> pa.Table:
        """For each anchor asked about, whether documents of different ids have it, and whether many blocks do."""
        rests = messages["rest"].to_pylist()
        rest = np.frombuffer(b"".join(rests), "<u4")
        ids = np.repeat(np.frombuffer(b"".join(messages["ids"].to_pylist()), "<i8"), np.frombuffer(b"".join(messages["runs"].to_pylist()), "<u4").astype(np.int64))
        order = np.argsort(rest, kind="stable")
        s, t = rest[order], ids[order]
        runs = _runs(s)
        low, high = np.minimum.reduceat(t, runs), np.maximum.reduceat(t, runs)
        n = np.diff(np.append(runs, len(s)))
        told, common = np.empty(len(rest), bool), np.empty(len(rest), bool)
        told[order] = np.repeat((low != high) | (low == SEVERAL), n)
        common[order] = np.repeat(n >= common_blocks, n)
        edges = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rests])))
        packed = lambda x: pa.array([np.packbits(x[i:j]).tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
        return pa.table({"block": messages["block"], "part": messages["part"], "bits": packed(told), "common": packed(common)})

    return run


# ------------------------------------------------- sorting suffixes

_SEND = "part int, block long, bytes binary, sizes binary, at binary, ids binary"
_BACK = "block long, part int, counts binary, lengths binary, ids binary"


def _send(parts: int):
    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block = Block(row["ids"], row["sizes"], row["text"])
        runs_of = block.occurrences(*_repeated(block, told, parts))
        one, least, edges, _ = block.stretches(runs_of, parts)
        first, many, at = (x[one] for x in runs_of[:3])
        size = many + (LENGTH - 1)
        joined = block.data[_spread(first, size)]
        byte_edges = np.concatenate(([0], np.cumsum(size)))[edges]
        chosen = np.flatnonzero(np.diff(edges)).tolist()
        return pa.table({
            "part": pa.array(chosen, pa.int32()), "block": pa.array([row["block"]] * len(chosen), pa.int64()),
            "bytes": pa.array(_cut(joined, byte_edges, chosen), pa.binary()), "sizes": pa.array(_cut(size.astype("u1"), edges, chosen), pa.binary()),
            "at": pa.array(_cut((at - first).astype("u1"), edges, chosen), pa.binary()), "ids": pa.array(_cut(least.astype("<i8"), edges, chosen), pa.binary()),
        })

    return run


def _repeated(block: Block, told: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor occurrence of the block, whether other documents have its anchor, and many blocks."""
    h, ids, edges, where = block.questions(parts)
    part = np.repeat(np.arange(parts), np.diff(edges))
    order = _by_part(part, ids)
    flags = np.zeros((2, len(h)), bool)
    for p, *bits in zip(told["part"].to_pylist(), told["bits"].to_pylist(), told["common"].to_pylist(), strict=True):
        n = int(edges[p + 1] - edges[p])
        for k in range(2):
            flags[k, order[edges[p] : edges[p + 1]]] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=n).astype(bool)
    return flags[0, where], flags[1, where]


class SuffixOrder:
    """Order of suffixes by their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.data, self.length, self.prefixes = data, length, Prefixes(data)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes ``x`` and ``y``, up to ``length``."""
        low = np.zeros(len(x), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            more = low + step
            can = more <= self.length
            more = np.where(can, more, low)
            same = can & (self.prefixes.of(x, more) == self.prefixes.of(y, more))
            low = np.where(same, more, low)
            step >>= 1
        return low

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix ``x`` comes after suffix ``y``."""
        out = np.zeros(len(x), bool)
        differ = np.flatnonzero(self.prefixes.of(x, self.length) != self.prefixes.of(y, self.length))
        if len(differ):
            a, b = x[differ], y[differ]
            n = self.common(a, b)
            inside = n < self.length
            n = np.minimum(n, self.length - 1)
            out[differ] = inside & (self.data[a + n] > self.data[b + n])
        return out

    def sort(self, suffixes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order that sorts suffixes within groups (equal values of ``group``): a mergesort from runs of one
        up, of all groups at once; each suffix finds its place in the run beside its own by binary search."""
        order = np.argsort(group, kind="stable")
        starts = _runs(group[order])
        sizes = np.diff(np.append(starts, len(order)))
        begin, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        width = 1
        open_ = np.flatnonzero(size > 1)
        while len(open_):
            place = open_ - begin[open_]
            run = place // width
            left = run % 2 == 0
            other = begin[open_] + np.where(left, run + 1, run - 1) * width
            end = begin[open_] + size[open_]
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            first = low.copy()
            x = suffixes[order[open_]]
            # how many of the other run come before: for the left run those smaller, for the right run those not larger
            going = np.flatnonzero(low < high)
            while len(going):
                mid = (low[going] + high[going]) >> 1
                y = suffixes[order[mid]]
                is_left = left[going]
                # one comparison each: an equal suffix of the left run comes first
                a, b = np.where(is_left, x[going], y), np.where(is_left, y, x[going])
                before = self.after(a, b) == is_left
                low[going] = np.where(before, mid + 1, low[going])
                high[going] = np.where(before, high[going], mid)
                going = going[low[going] < high[going]]
            own = place - run * width
            to = begin[open_] + np.where(left, run, run - 1) * width + own + (low - first)
            merged = order.copy()
            merged[to] = order[open_]
            order = merged
            width *= 2
            open_ = open_[size[open_] > width]
        return order

    def same(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether two suffixes agree in ``length`` bytes: by hash, then by their bytes."""
        equal = self.prefixes.of(x, self.length) == self.prefixes.of(y, self.length)
        return equal & equal_bytes(self.data, x, y, self.length)


def equal_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Whether the strings at ``x`` and ``y`` are equal, eight bytes at a time (lengths of eight at least)."""
    eight = np.ndarray((max(0, len(data) - 7),), "<u8", data.tobytes(), strides=(1,))
    out = np.ones(len(x), bool)
    last = np.asarray(length) - 8
    for k in range(0, int(np.max(last, initial=0)) + 8, 8):
        step = np.minimum(k, last)
        out &= eight[x + step] == eight[y + step]
    return out


def least_ids(data: np.ndarray, sizes: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every stretch the smallest id whose stretches hold an equal window. Also how many
    windows each stretch has."""
    begin = np.cumsum(sizes) - sizes
    many = sizes - (LENGTH - 1)
    order_ = SuffixOrder(data)
    # equal stretches count as one
    key = mix(order_.prefixes.of(begin, sizes) + _shape(sizes, at))
    by = np.argsort(key, kind="stable")
    new = np.ones(len(by), bool)
    near = np.flatnonzero(key[by][1:] == key[by][:-1])
    x, y = by[near], by[near + 1]
    new[1:][near] = ~((sizes[x] == sizes[y]) & (at[x] == at[y]) & equal_bytes(data, begin[x], begin[y], np.minimum(sizes[x], sizes[y])))
    runs = np.flatnonzero(new)
    one = by[runs]
    least = np.minimum.reduceat(ids[by], runs) if len(runs) else ids
    which = np.empty(len(by), np.int64)
    which[by] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(by))))
    # suffixes at the windows of different stretches, where an anchor has several
    anchor = order_.prefixes.of(begin[one] + at[one], ANCHOR)
    _, inverse, n = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[inverse] > 1)
    start = _spread(begin[one[several]], many[one[several]])
    of = np.repeat(several, many[one[several]])
    place = at[one[of]] - (start - begin[one[of]])
    group = mix(anchor[of] + place.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    order = order_.sort(start, group)
    s, g = start[order], group[order]
    new = np.ones(len(s), bool)
    near = np.flatnonzero(g[1:] == g[:-1])
    new[1:][near] = ~order_.same(s[near], s[near + 1])
    runs = np.flatnonzero(new)
    answer = np.empty(len(s), np.int64)
    if len(s):
        answer[order] = np.repeat(np.minimum.reduceat(least[of][order], runs), np.diff(np.append(runs, len(s))))
    # answers of all windows of all different stretches, then of all stretches
    each = many[one]
    first = np.cumsum(each) - each
    whole = np.repeat(least, each)
    whole[_spread(first[several], each[several])] = answer
    return whole[_spread(first[which], many)], many


def _pieces(sizes: np.ndarray, may_end: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes, which end only where they may."""
    if not len(sizes):
        return
    total = np.cumsum(sizes)
    stops = np.searchsorted(total, np.arange(PIECE, int(total[-1]) + PIECE, PIECE)).clip(0, len(sizes) - 1)
    if may_end is not None:
        ends = np.flatnonzero(may_end)
        stops = ends[np.searchsorted(ends, stops)]
    i = 0
    for j in np.unique(np.append(stops, len(sizes) - 1)).tolist():
        yield i, j + 1
        i = j + 1


def _sorted(messages: pa.Table) -> pa.Table:
    joined = lambda c, t: np.frombuffer(b"".join(messages[c].to_pylist()), t)
    sizes, at, ids = joined("sizes", "u1").astype(np.int64), joined("at", "u1").astype(np.int64), joined("ids", "<i8")
    data, begin, many = joined("bytes", np.uint8), np.cumsum(sizes) - sizes, sizes - (LENGTH - 1)
    # pieces that fit the processor's cache: stretches of one anchor stay together
    anchor = np.empty(len(sizes), np.uint64)
    for i, j in _pieces(sizes):
        anchor[i:j] = Prefixes(data[begin[i] : begin[j - 1] + sizes[j - 1]]).of(begin[i:j] - begin[i] + at[i:j], ANCHOR)
    by = np.argsort(anchor, kind="stable")
    last = np.append(anchor[by][1:] != anchor[by][:-1], True) if len(by) else np.zeros(0, bool)
    least, first = np.empty(int(many.sum()), np.int64), np.cumsum(many) - many
    for i, j in _pieces(sizes[by], last):
        own = by[i:j]
        found, _ = least_ids(data[_spread(begin[own], sizes[own])], sizes[own], at[own], ids[own])
        least[_spread(first[own], many[own])] = found
    # runs of equal answers within each stretch
    of = np.repeat(np.arange(len(sizes)), many)
    runs = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (least[1:] != least[:-1]))))
    lengths, counts = np.diff(np.append(runs, len(of))), np.bincount(of[runs], minlength=len(sizes))
    rows = np.array([len(x) for x in messages["sizes"].to_pylist()])
    edges = np.concatenate(([0], np.cumsum(rows)))
    run_edges = np.concatenate(([0], np.cumsum(counts)))[edges]
    every = list(range(len(rows)))
    return pa.table({
        "block": messages["block"], "part": messages["part"], "counts": pa.array(_cut(counts.astype("u1"), edges, every), pa.binary()),
        "lengths": pa.array(_cut(lengths.astype("u1"), run_edges, every), pa.binary()), "ids": pa.array(_cut(least[runs].astype("<i8"), run_edges, every), pa.binary()),
    })


# ------------------------------------------------- marking

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_bytes(block: Block, told: pa.Table, back: pa.Table, parts: int) -> np.ndarray:
    """Whether each byte of the block goes."""
    runs_of = block.occurrences(*_repeated(block, told, parts))
    first, _, _, _, _, doc = runs_of
    _, _, _, where = block.stretches(runs_of, parts)
    counts = [np.zeros(0, np.int64)] * parts
    lengths, ids = list(counts), list(counts)
    for p, c, n, i in zip(*[back[x].to_pylist() for x in ("part", "counts", "lengths", "ids")], strict=True):
        counts[p], lengths[p], ids[p] = np.frombuffer(c, "u1").astype(np.int64), np.frombuffer(n, "u1").astype(np.int64), np.frombuffer(i, "<i8")
    counts, lengths, ids = np.concatenate(counts), np.concatenate(lengths), np.concatenate(ids)
    first_run = np.cumsum(counts) - counts
    before = np.cumsum(lengths) - lengths
    # the runs of each occurrence: from its stretch, moved to its place
    n = counts[where]
    r = _spread(first_run[where], n)
    start = np.repeat(first, n) + before[r] - np.repeat(before[first_run[where]], n) if len(r) else r
    gone = ids[r] < block.ids[np.repeat(doc, n)]
    n = len(block.data)
    edge = np.bincount(start[gone], minlength=n + 1).astype(np.int32)
    edge -= np.bincount(start[gone] + lengths[r][gone] + (LENGTH - 1), minlength=n + 1).astype(np.int32)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _mark(parts: int):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block = Block(row["ids"], row["sizes"], row["text"])
        is_back = pc.is_valid(answers["counts"])
        gone = removed_bytes(block, answers.filter(pc.invert(is_back)), answers.filter(is_back), parts)
        kept = block.data[~gone].tobytes()
        sums = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
        ends = (block.offsets - sums[block.offsets]).tolist()
        starts = gone & ~np.concatenate(([False], gone[:-1]))
        heads = block.offsets[:-1][block.sizes > 0]
        starts[heads] = gone[heads]
        spans = np.concatenate(([0], np.cumsum(starts)))
        digests = [hashlib.sha256(kept[s:e]).hexdigest() for s, e in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({
            "doc_id": pa.array(block.ids, pa.int64(), mask=block.ids == NONE), "n_bytes": pa.array(block.sizes),
            "n_removed": pa.array(np.diff(sums[block.offsets])), "n_spans": pa.array(np.diff(spans[block.offsets])), "kept_sha256": pa.array(digests, pa.string()),
        })

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for b in batches:
        for s, e in chunks(b.column("text")):
            part = b.slice(s, e - s)
            data, offsets = buffers(part.column("text"))
            ids = pc.fill_null(part.column("doc_id"), int(NONE)).to_numpy().astype("<i8")
            block += 1
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([ids.tobytes()]), pa.array([np.diff(offsets).astype("<i8").tobytes()]), pa.array([data.tobytes()], pa.binary())], names=["block", "ids", "sizes", "text"])


def remove_repeats(docs: DataFrame, common_blocks: int = COMMON_BLOCKS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs(doc_id, text)``."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    parts, buckets = max(8, -(-total // PART_BYTES)), max(8, -(-total // BUCKET_BYTES))
    name = f"outpost_blocks_{uuid.uuid4().hex}"
    packed = rows.mapInArrow(_pack, "block long, ids binary, sizes binary, text binary")
    packed.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "block").saveAsTable(name)
    try:
        blocks = spark.table(name)
        asked = blocks.mapInArrow(_ask(parts), _ASK)
        told = write_table(asked.groupBy("part").applyInArrow(_tell(common_blocks), _TOLD), "told")
        sent = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_send(parts), _SEND)
        back = sent.groupBy("part").applyInArrow(_sorted, _BACK)
        nothing = lambda kind: F.lit(None).cast(kind)
        answers = told.select("block", "part", "bits", "common", nothing("binary").alias("counts"), nothing("binary").alias("lengths"), nothing("binary").alias("ids"))
        answers = answers.unionByName(back.select("block", "part", nothing("binary").alias("bits"), nothing("binary").alias("common"), "counts", "lengths", "ids"))
        return write_table(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_mark(parts), _RESULT), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

