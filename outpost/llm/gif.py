"""GIF media columns: samples to GIF bytes, and GIF bytes to timed frames with colour histograms.

Decoding reads the LZW code streams of many frames at once. The widths of the codes follow from their number
since the last clear code alone, so codes are cut out as arrays; the string of a code is what the output
holds where its table entry was made, so every output byte points to an earlier one, and following the
pointers in doubling steps ends at literal bytes. Frames are then drawn one after another: local or global
palette, interlacing, transparent index, disposal (keep, to background, to previous).

One pass over the rows, no shuffle; a task holds about ``CHUNK`` bytes of samples at once, or one file.

Defined results. A null or empty text is one row of 192 blanks. A media value that is null, no GIF or broken is
one row with its id, null results and the reason in ``error``, which is null otherwise; other rows don't notice. A
GIF without images has no frames. A code stream that ends early leaves the missing pixels at index 0, and pixels
beyond the frame are ignored. Repeated ids are separate rows; other columns are not kept by the query,
``frames`` keeps the id alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from outpost.llm.store import small_batches

WIDTH = 192
FRAME_ROWS = 64
DELAY_CS = 4
BINS = 16
CHUNK = 1 << 20
MOST_CODES = 4096


def _widths(min_code: int, n: int) -> np.ndarray:
    """Bits of the codes 0 to n - 1 after a clear code."""
    table = (1 << min_code) + 2 + np.maximum(0, np.arange(n) - 1)
    bits = np.frexp(table.astype(np.float64))[1]
    return np.clip(bits, min_code + 1, 12).astype(np.int64)


_WIDTHS = {m: _widths(m, 2 * MOST_CODES) for m in range(2, 9)}
_ENDS = {m: np.cumsum(w) for m, w in _WIDTHS.items()}


# ---------------------------------------------------------------- writing


def lzw_codes(samples: bytes) -> tuple[list[int], list[int]]:
    """Codes of 8-bit samples, clear codes included, and for each its number since the last clear code."""
    codes, places = [256], [0]
    table: dict[int, int] = {}
    get, add = table.get, codes.append
    free, since = 258, 0
    run = -1
    for c in samples:
        if run < 0:
            run = c
            continue
        key = run << 8 | c
        found = get(key)
        if found is not None:
            run = found
            continue
        add(run)
        table[key] = free
        free += 1
        run = c
        if free == MOST_CODES:
            n = len(codes) - len(places)
            places += range(since, since + n)
            add(256)
            places.append(since + n)
            table.clear()
            free, since = 258, 0
    if run >= 0:
        add(run)
    add(257)
    n = len(codes) - len(places)
    places += range(since, since + n)
    return codes, places


_BIT = np.arange(12)


def pack(codes: list[int], places: list[int]) -> bytes:
    widths = _WIDTHS[8][np.asarray(places)]
    bits = (np.asarray(codes, np.int32)[:, None] >> _BIT) & 1
    return np.packbits(bits.astype(np.uint8)[_BIT < widths[:, None]], bitorder="little").tobytes()


def sub_blocks(data: bytes) -> bytes:
    return b"".join(bytes((len(x),)) + x for x in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


_GREYS = bytes(np.repeat(np.arange(256, dtype=np.uint8), 3))


def encode(samples: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS) -> bytes:
    """A GIF of grey samples: rows of ``width``, cut into frames of ``frame_rows``."""
    step = width * frame_rows
    height = min(frame_rows, len(samples) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), _GREYS, b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00"]
    for i in range(0, len(samples), step):
        part = samples[i : i + step]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_cs, 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, width, len(part) // width, 0, 8))
        out.append(sub_blocks(pack(*lzw_codes(part))))
    return b"".join(out) + b"\x3b"


# ---------------------------------------------------------------- reading


@dataclass
class Image:
    """One image of a file as read, not drawn yet."""

    left: int
    top: int
    width: int
    height: int
    palette: np.ndarray
    transparent: int
    disposal: int
    delay_cs: int
    interlaced: bool
    min_code: int
    data: bytes


def _blocks(b: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := b[at]:
        parts.append(b[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def _palette(b: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 3 << ((flags & 7) + 1)
    table = np.zeros((256, 3), np.uint8)
    table[: n // 3] = np.frombuffer(b, np.uint8, n, at).reshape(-1, 3)
    return table, at + n


def parse(b: bytes) -> tuple[int, int, list[Image]]:
    """Canvas size and images of a file."""
    if b[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    try:
        width, height, flags = struct.unpack_from("<HHB", b, 6)
        shared, at = _palette(b, 13, flags)
        images, control = [], (0, 0, -1)
        while b[at] != 0x3B:
            kind = b[at]
            if kind == 0x21:
                label, at = b[at + 1], at + 2
                data, at = _blocks(b, at)
                if label == 0xF9:
                    f, delay, index = struct.unpack_from("<BHB", data)
                    control = (f >> 2 & 7, delay, index if f & 1 else -1)
            elif kind == 0x2C:
                left, top, w, h, flags = struct.unpack_from("<HHHHB", b, at + 1)
                own, at = _palette(b, at + 10, flags)
                palette = own if own is not None else shared if shared is not None else np.zeros((256, 3), np.uint8)
                min_code = b[at]
                data, at = _blocks(b, at + 1)
                images.append(Image(left, top, w, h, palette, control[2], control[0], control[1], bool(flags & 0x40), min_code, data))
                control = (0, 0, -1)
            else:
                raise ValueError(f"unknown block {kind}")
    except (IndexError, struct.error) as e:
        raise ValueError("truncated GIF") from e
    return width, height, images


def read_codes(data: bytes, min_code: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of one stream without clear and end codes, and for each where its run since a clear code began."""
    if not 2 <= min_code <= 8:
        raise ValueError("bad code size")
    clear = 1 << min_code
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    ends, widths = _ENDS[min_code], _WIDTHS[min_code]
    out, starts, bit, since, total, began = [], [], 0, 0, 0, 0
    n = 256
    while True:
        # the codes at places since, since + 1, ... as far as a guess of n and the data go
        left = len(data) * 8 - bit
        if since + n > len(ends):
            step = np.full(n, 12)
            stops = 12 * np.arange(1, n + 1)
        else:
            step = widths[since : since + n]
            stops = ends[since : since + n] - (ends[since - 1] if since else 0)
        m = int(np.searchsorted(stops, left, "right"))
        if not m:
            break
        at = bit + stops[:m] - step[:m]
        byte = at >> 3
        window = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        codes = (window >> (at & 7).astype(np.uint32) & ((1 << step[:m]) - 1).astype(np.uint32)).astype(np.int32)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        k = int(stop[0]) if len(stop) else m
        out.append(codes[:k])
        starts.append(np.full(k, began, np.int64))
        total += k
        if not len(stop):
            bit, since, n = bit + int(stops[m - 1]), since + m, min(2 * n, MOST_CODES)
            continue
        if codes[k] != clear:
            break
        bit, since, began, n = bit + int(stops[k]), 0, total, max(256, min(2 * n, MOST_CODES))
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(starts)


def expand(codes: np.ndarray, starts: np.ndarray, clear: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Samples of codes, and how many each code gives. starts: where each code's run began; clear: the clear
    code, one for all or one for each."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    here = np.arange(n)
    literal = codes < clear
    entry = np.where(literal, here, starts + codes - clear - 2)
    if ((entry >= here) & ~literal).any() or (entry < starts).any():
        raise ValueError("code before its entry")
    depth, to = (~literal).astype(np.int64), entry
    rounds = 1
    while not literal[to].all():
        depth = depth + depth[to]
        to = to[to]
        rounds += 1
    size = depth + 1
    end = np.cumsum(size)
    begin = end - size
    total = int(end[-1])
    back = (begin - begin[entry]).astype(np.int32)
    source = np.arange(total, dtype=np.int32) - np.repeat(back, size)
    for _ in range(rounds + 1):
        source = source[source]
    first = np.zeros(total, np.uint8)
    first[begin[literal]] = codes[literal]
    out = first[source]
    return out, size


def _deinterlace(rows: np.ndarray) -> np.ndarray:
    order = np.concatenate([np.arange(s, len(rows), d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
    out = np.empty_like(rows)
    out[order] = rows
    return out


def samples_of(images: list[Image]) -> list[np.ndarray]:
    """Palette indices (height, width) of all images, decoded together."""
    coded = [read_codes(i.data, i.min_code) for i in images]
    sizes = np.array([len(c) for c, _ in coded], np.int64)
    ends = np.cumsum(sizes)
    if not len(images):
        return []
    codes = np.concatenate([c for c, _ in coded])
    starts = np.concatenate([s + e - n for (_, s), e, n in zip(coded, ends, sizes, strict=True)])
    clear = np.repeat(np.array([1 << i.min_code for i in images]), sizes)
    data, each = expand(codes, starts, clear)
    stops = np.concatenate(([0], np.cumsum(each)))
    out = []
    for i, e, n in zip(images, ends.tolist(), sizes.tolist(), strict=True):
        part = data[stops[e - n] : stops[e]][: i.width * i.height]
        if len(part) < i.width * i.height:
            part = np.concatenate((part, np.zeros(i.width * i.height - len(part), np.uint8)))
        rows = part.reshape(i.height, i.width)
        out.append(_deinterlace(rows) if i.interlaced else rows)
    return out


def draw(width: int, height: int, images: list[Image], indices: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The canvas (height, width, RGBA) as each frame shows it. The array is drawn over by the next frame."""
    canvas = np.zeros((height, width, 4), np.uint8)
    for i, index in zip(images, indices, strict=True):
        h, w = min(i.height, max(0, height - i.top)), min(i.width, max(0, width - i.left))
        area = canvas[i.top : i.top + h, i.left : i.left + w]
        before = area.copy() if i.disposal == 3 else None
        index = index[:h, :w]
        if i.transparent < 0:
            area[..., :3] = i.palette[index]
            area[..., 3] = 255
        else:
            seen = index != i.transparent
            area[seen, :3] = i.palette[index[seen]]
            area[seen, 3] = 255
        yield canvas
        if i.disposal == 2:
            area[:] = 0
        elif before is not None:
            area[:] = before


def histogram(rgb: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of red, green and blue values in ``bins`` equal ranges each, one after another."""
    step = 256 // bins
    return np.concatenate([np.bincount((rgb[..., k] // step).ravel(), minlength=bins) for k in range(3)])


# ---------------------------------------------------------------- Spark


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > CHUNK:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def store_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: UTF-8 texts, padded with blanks to whole rows of samples, as GIF bytes."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            raw = [(t.as_py() or "").encode() for t in texts]
            for s, e in _chunks([len(x) for x in raw]):
                media = [encode(x + b" " * (max(WIDTH, -(-len(x) // WIDTH) * WIDTH) - len(x))) for x in raw[s:e]]
                yield pa.RecordBatch.from_arrays([ids.slice(s, e - s), pa.array([len(x) for x in raw[s:e]], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


_File = tuple[int, int, list[Image], list[np.ndarray]]


def _decoded(media: list[bytes | None]) -> list[_File | str]:
    """Canvas size, images and indices of files, which are decoded together; for one that can't be read, why."""
    try:
        parsed = [parse(x or b"") for x in media]
        indices = iter(samples_of([x for p in parsed for x in p[2]]))
        return [(w, h, images, [next(indices) for _ in images]) for w, h, images in parsed]
    except ValueError as e:
        # of one file, so each is read by itself
        return [str(e)] if len(media) == 1 else [y for x in media for y in _decoded([x])]


def _files(b: pa.RecordBatch) -> Iterator[tuple[int, bytes | None, _File | str]]:
    """Row number, bytes, and what they decode to, of each file of a batch."""
    media = b.column(b.schema.get_field_index("media")).to_pylist()
    for s, e in _chunks([2 * len(x or b"") for x in media]):
        yield from zip(range(s, e), media[s:e], _decoded(media[s:e]), strict=True)


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.types, strict=True)], schema=types)


_FRAMES = "doc_id long, frame int, start_ms long, delay_ms int, left int, top int, width int, height int, disposal int, transparent int, red array<int>, green array<int>, blue array<int>, pixels binary, error string"


def frames(stored: DataFrame) -> DataFrame:
    """``stored(doc_id, media)`` to one row per frame: its time, place and rules, histograms of the canvas as
    shown, and the canvas itself as RGBA bytes."""
    small_batches(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column("doc_id").to_pylist(), []
            for i, _, file in _files(b):
                if isinstance(file, str):
                    rows.append((ids[i], *[None] * (len(_FRAME_TYPES) - 2), file))
                    continue
                ms, (w, h, images, indices) = 0, file
                for k, (x, canvas) in enumerate(zip(images, draw(w, h, images, indices), strict=True)):
                    hist = histogram(canvas).tolist()
                    rows.append((ids[i], k, ms, 10 * x.delay_cs, x.left, x.top, x.width, x.height, x.disposal, x.transparent, hist[:BINS], hist[BINS : 2 * BINS], hist[2 * BINS :], canvas.tobytes(), None))
                    ms += 10 * x.delay_cs
            yield _batch(rows, _FRAME_TYPES)

    return stored.select(F.col("doc_id").cast("long").alias("doc_id"), "media").mapInArrow(run, _FRAMES)


_FRAME_TYPES = pa.schema(
    [("doc_id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64())]
    + [(c, pa.int32()) for c in ("delay_ms", "left", "top", "width", "height", "disposal", "transparent")]
    + [(c, pa.list_(pa.int32())) for c in ("red", "green", "blue")] + [("pixels", pa.binary()), ("error", pa.string())]
)

_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
_FEATURE_TYPES = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _FEATURES.split(", ")])


def features(stored: DataFrame) -> DataFrame:
    """``store_texts``' rows to digests of what the stored bytes show: the red samples of each frame's area,
    read from the drawn canvas, and as ``feature`` the frames, their time and their red histogram."""
    small_batches(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes = b.column("doc_id").to_pylist(), b.column("n_bytes").to_pylist()
            out = []
            for i, blob, file in _files(b):
                if isinstance(file, str):
                    out.append((ids[i], sizes[i], *[None] * (len(_FEATURE_TYPES) - 3), file))
                    continue
                parts, hist, (w, h, images, indices) = [], np.zeros(3 * BINS, np.int64), file
                for x, canvas in zip(images, draw(w, h, images, indices), strict=True):
                    area = canvas[x.top : x.top + x.height, x.left : x.left + x.width]
                    parts.append(np.ascontiguousarray(area[..., 0]).tobytes())
                    hist += histogram(area[..., :3])
                payload = b"".join(parts)
                feature = f"{w}x{h} frames={len(images)} ms={10 * sum(x.delay_cs for x in images)} red={','.join(map(str, hist[:BINS]))}"
                out.append((ids[i], sizes[i], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(blob), hashlib.sha256(blob).hexdigest(), feature, None))
            yield _batch(out, _FEATURE_TYPES)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, _FEATURES)
