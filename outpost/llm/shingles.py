"""Hashed word shingles of whole texts, many texts at once.

A prefix sum of byte values times powers of an odd number gives the hash of any run of bytes as a difference
(mod 2**64), so words are hashed without a loop over them; five word hashes make a shingle hash."""

from __future__ import annotations

import numpy as np

WORDS = 5
_R = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xD1342543DE82EF95)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


KEPT_POWERS = 1 << 21
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, or more of them. Tables of ordinary size are kept."""
    for size, tables in _powers.items():
        if size > n:
            return tables
    size = 1 << max(12, n.bit_length())
    both = []
    for base in (int(_R), _inverse(int(_R))):
        p = np.ones(1, np.uint64)
        step = base
        while len(p) < size:
            p = np.concatenate((p, p * np.uint64(step)))
            step = step * step % (1 << 64)
        both.append(p)
    if size <= KEPT_POWERS:
        _powers.clear()
        _powers[size] = (both[0], both[1])
    return both[0], both[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a fixed bijection)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A 64-bit value for each byte, A-Z as a-z.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _C)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the text it is in. data, offsets: UTF-8 of the texts, one after another."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = _BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.empty(n, bool)
    start[0] = True
    np.logical_or(blank[:-1], edge[1:n], out=start[1:])
    start &= ~blank
    end = np.empty(n, bool)
    end[-1] = True
    np.logical_or(blank[1:], edge[1:n], out=end[:-1])
    end &= ~blank
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    h = mix((sums[e] - sums[s]) * down[s])
    return h, np.searchsorted(offsets, s, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and how many each text has. A text with
    fewer words has its whole sequence as one shingle, a text without words none."""
    n = len(offsets) - 1
    h, doc = word_hashes(data, offsets)
    per = np.bincount(doc, minlength=n)
    m = max(0, len(h) - words + 1)
    out = np.zeros(m, np.uint64)
    for k in range(words):
        out *= _C
        out += h[k : k + m]
    whole = doc[:m] == doc[words - 1 :]
    hashes, docs = mix(out[whole]), doc[:m][whole]
    short = np.flatnonzero((per > 0) & (per < words))
    if len(short):
        first = np.concatenate(([0], np.cumsum(per)))[short]
        acc = per[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for k in range(words - 1):
            more = k < per[short]
            acc[more] = acc[more] * _C + h[first[more] + k]
        hashes, docs = np.concatenate((hashes, mix(acc))), np.concatenate((docs, short))
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    if len(hashes):
        keep = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])))
        hashes, docs = hashes[keep], docs[keep]
    return hashes, np.bincount(docs, minlength=n)
