"""Cut texts into the words that a tokenizer encodes one by one, and encode each different word once.

Most texts are plain: ASCII and the Latin letters of two bytes that start with 0xC3, without apostrophes or
control characters. For those the cuts are found for a whole batch at once from byte classes; all other texts
go through the tokenizer's own pattern. Both ways give the same words.

Ids of words stay in a table of a fixed number of slots. A word of up to sixteen bytes is its own key there, as two
integers, so words are told apart by what they are, and all words of a batch are looked up at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Byte classes.
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 1 << 21
#: Slots for words of up to sixteen bytes, and ids of all of them before the slots are emptied.
SLOTS = 1 << 21
POOL = 1 << 22
#: Longer words of which the ids are kept.
KEEP_LONG = 20_000


def _classes() -> np.ndarray:
    c = np.full(256, ODD, np.uint8)
    c[0x21:0x7F] = OTHER
    c[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
    c[0x30:0x3A] = DIGIT
    c[0x41:0x5B] = c[0x61:0x7B] = LETTER
    c[0x80:0xC0] = c[0xC3] = LETTER
    c[0x27] = ODD
    return c


CLASSES = _classes()


def _odd(data: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Bytes that make a text not plain."""
    lead = data == 0xC3
    after = np.concatenate(([False], lead[:-1]))
    tail = (data >= 0x80) & (data < 0xC0)
    return (cls == ODD) | (tail & (~after | (data == 0x97) | (data == 0xB7)))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``CHUNK`` bytes, or of one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > CHUNK:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their offsets (null: empty)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


#: What of an eight-byte integer belongs to its first 0 to 8 bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordIds:
    """Ids of words, looked up by the places of the words in a buffer. A slot holds the last word that fell into
    it. ``new_words`` gives the ids of words (UTF-8) as 32-bit integers in bytes."""

    def __init__(self, new_words: Callable[[list[bytes]], list[bytes]], slots: int, pool: int):
        self.new_words, self.shift = new_words, np.uint64(65 - slots.bit_length())
        self.head, self.tail = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.start, self.size = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.pool, self.used = np.zeros(pool, np.uint32), 0
        self.long: dict[bytes, bytes] = {}

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        ids = [self.long.get(w) for w in words]
        ask = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(ask, self.new_words([words[i] for i in ask]) if ask else [], strict=True):
            ids[i] = x
            if len(words[i]) > 16 and len(self.long) < KEEP_LONG:
                self.long[words[i]] = x
        return ids

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and each word's place there and number of ids. No word is empty or has zero bytes."""
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[: len(data)] = data
        eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
        length = ends - starts
        cut = np.minimum(length, 8)
        head, tail = eight[starts] & _FIRST[cut], eight[starts + cut] & _FIRST[np.clip(length - 8, 0, 8)]
        slot = tail * np.uint64(0x9E3779B97F4A7C15) + head
        slot ^= slot >> np.uint64(32)
        slot = ((slot * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)
        short = length <= 16
        at, size = self.start[slot].astype(np.int64), self.size[slot].astype(np.int64)
        missing = np.flatnonzero(~(short & (self.head[slot] == head) & (self.tail[slot] == tail)))
        if not len(missing):
            return self.pool, at, size
        text, different = data.tobytes(), {}
        which = np.array([different.setdefault(text[s:e], len(different)) for s, e in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)])
        ids = self._encoded(list(different))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        new, places = np.frombuffer(b"".join(ids), np.uint32), self.used + np.cumsum(sizes) - sizes
        at[missing], size[missing] = places[which], sizes[which]
        if self.used + len(new) > len(self.pool):
            whole = np.concatenate((self.pool[: self.used], new))
            self.head[:], self.used = 0, 0
            return whole, at, size
        self.pool[self.used : self.used + len(new)] = new
        self.used += len(new)
        # words of one slot: the last one stays, in all columns
        kept = missing[short[missing]]
        into = slot[kept]
        self.head[into], self.tail[into], self.start[into], self.size[into] = head[kept], tail[kept], at[kept], size[kept]
        return self.pool, at, size


class Encoder:
    """Texts to token ids. ``new_words`` gives the ids of words (UTF-8) as 32-bit
    integers in bytes; ``odd_text`` gives the ids of a
    text that is not plain; ``tiled`` cuts as byte-level tokenizers do (a word keeps one space before it and
    white space counts), else white space is dropped, digits stand alone and letters are lowered."""

    def __init__(self, new_words: Callable[[list[bytes]], list[bytes]], odd_text: Callable[[str], list[int]], tiled: bool, special: tuple[bytes, ...], slots: int = SLOTS, pool: int = POOL):
        self.odd_text, self.tiled, self.special = odd_text, tiled, special
        self.words = WordIds(new_words, slots, pool)

    def _cuts(self, data: np.ndarray, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words start. first: starts of texts."""
        edge = np.zeros(len(data), bool)
        edge[first] = True
        space = cls == SPACE
        changed = np.empty(len(data), bool)
        changed[0] = True
        np.not_equal(cls[1:], cls[:-1], out=changed[1:])
        if not self.tiled:
            lone = cls == DIGIT
            return np.flatnonzero(edge | changed | lone)
        after_blank = np.concatenate(([False], data[:-1] == 0x20))
        last = np.empty(len(data), bool)  # the next byte is of the same text and no space
        last[-1] = False
        np.logical_and(~space[1:], ~edge[1:], out=last[:-1])
        start = np.where(space, changed | last, changed & ~after_blank)
        return np.flatnonzero(edge | start)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        flat, counts = [np.zeros(0, np.uint32)], []
        for a, b in chunks(texts):
            part = texts.slice(a, b - a)
            data, offsets = buffers(part)
            cls = CLASSES[data]
            bad = np.zeros(b - a, bool)
            rows = np.flatnonzero(np.diff(offsets) > 0)
            if len(rows):
                bad[rows] = np.logical_or.reduceat(_odd(data, cls), offsets[rows])
                text = data.tobytes()
                if any(s in text for s in self.special):
                    for i in rows:
                        if any(s in text[offsets[i] : offsets[i + 1]] for s in self.special):
                            bad[i] = True
            if not bad.any():
                f, c = self._plain(data, cls, offsets)
                flat.append(f)
                counts.append(c)
                continue
            lengths = np.diff(offsets)
            keep = np.repeat(~bad, lengths)
            new = np.concatenate(([0], np.cumsum(np.where(bad, 0, lengths))))
            f, c = self._plain(data[keep], cls[keep], new)
            ends = np.cumsum(c)
            pieces, done = [], 0
            for i in np.flatnonzero(bad):
                pieces.append(f[done : ends[i]])
                done = ends[i]
                pieces.append(np.asarray(self.odd_text(data[offsets[i] : offsets[i + 1]].tobytes().decode()), np.uint32))
                c[i] = len(pieces[-1])
            flat += [*pieces, f[done:]]
            counts.append(c)
        return np.concatenate(flat), np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def _plain(self, data: np.ndarray, cls: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        first = np.unique(offsets[:-1][np.diff(offsets) > 0])
        cuts = self._cuts(data, cls, first)
        if not self.tiled:
            up = (data >= 0x41) & (data <= 0x5A)
            up[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
            data = data + np.where(up, np.uint8(32), np.uint8(0))
        ends = np.append(cuts[1:], len(data))
        word = np.ones(len(cuts), bool) if self.tiled else CLASSES[data[cuts]] != SPACE
        pool, at, size = self.words.find(data, cuts[word], ends[word])
        n = np.zeros(len(cuts), np.int64)
        n[word] = size
        to = np.cumsum(size)
        flat = pool[np.repeat(at - (to - size), size) + np.arange(size.sum())]
        before = np.concatenate(([0], np.cumsum(n)))
        return flat, np.diff(before[np.searchsorted(cuts, offsets)])
