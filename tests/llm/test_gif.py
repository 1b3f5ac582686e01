import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from outpost.llm import gif


def plain_decode(data, min_code):
    """A decoder by the book, bit by bit."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    clear, at, out = 1 << min_code, 0, bytearray()
    table, width, prev = None, min_code + 1, None
    while at + width <= len(bits):
        code = int(sum(int(b) << k for k, b in enumerate(bits[at : at + width])))
        at += width
        if code == clear:
            table, width, prev = {i: bytes([i]) for i in range(clear)}, min_code + 1, None
            free = clear + 2
            continue
        if code == clear + 1:
            break
        if prev is None:
            entry = table[code]
        else:
            entry = table[code] if code in table else prev + prev[:1]
            if free < 4096:
                table[free] = prev + entry[:1]
                free += 1
                if free == 1 << width and width < 12:
                    width += 1
        out += entry
        prev = entry
    return bytes(out)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=1, max_size=4), st.integers(1, 400)), max_size=8))
def test_lzw(parts):
    data = b"".join(a * n for a, n in parts)
    packed = gif.pack(*gif.lzw_codes(data))
    assert plain_decode(packed, 8) == data
    got, _ = gif.expand(*gif.read_codes(packed, 8), 256)
    assert got.tobytes() == data


def test_long_noise():
    data = np.random.default_rng(1).integers(0, 256, 60_000, np.uint8).tobytes()
    packed = gif.pack(*gif.lzw_codes(data))
    assert gif.expand(*gif.read_codes(packed, 8), 256)[0].tobytes() == data == plain_decode(packed, 8)


def bits(codes, min_code):
    s = "".join(format(c, f"0{w}b")[::-1] for c, w in codes)
    return np.packbits(np.array([int(x) for x in s.ljust(-(-len(s) // 8) * 8, "0")], np.uint8), bitorder="little").tobytes()


def file_of(frames, size=(4, 2), palette=b"\0\0\0\xff\0\0\0\xff\0\0\0\xff"):
    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x81, 0, 0) + palette
    for f in frames:
        index, left, top, w, h, disposal, transparent, delay, own, interlaced = f
        out += struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (transparent >= 0), delay, max(0, transparent), 0)
        out += struct.pack("<BHHHHB", 0x2C, left, top, w, h, (0x81 if own else 0) | (0x40 if interlaced else 0)) + (own or b"") + b"\2"
        codes = [(4, 3)]
        for c in index:  # a clear code before each sample: all codes have three bits
            codes += [(c, 3), (4, 3)]
        out += gif.sub_blocks(bits([*codes, (5, 3)], 2))
    return out + b"\x3b"


def shown(blob):
    w, h, images = gif.parse(blob)
    return [c.copy() for c in gif.draw(w, h, images, gif.samples_of(images))], images


def test_rules():
    red, green, blue, none = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255], [0, 0, 0, 0]
    full = [1] * 8
    own = b"\1\1\1\2\2\2\3\3\3\4\4\4"
    canvases, images = shown(file_of([
        (full, 0, 0, 4, 2, 1, -1, 5, None, False),
        ([2, 0], 1, 0, 2, 1, 3, 0, 7, None, False),  # index 0 is transparent; back to what was before
        ([3, 3], 0, 1, 2, 1, 2, -1, 9, None, False),  # then to background
        ([2, 2], 2, 0, 2, 1, 1, -1, 1, own, False),  # a palette of its own
    ]))
    assert [i.delay_cs for i in images] == [5, 7, 9, 1]
    assert (canvases[0] == red).all()
    assert canvases[1][0].tolist() == [red, green, red, red]
    assert canvases[2].tolist() == [[red] * 4, [blue, blue, red, red]]
    assert canvases[3].tolist() == [[red, red, [3, 3, 3, 255], [3, 3, 3, 255]], [none, none, red, red]]


def test_interlaced():
    rows = [[i % 4] * 4 for i in range(9)]
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7]
    blob = file_of([(sum((rows[i] for i in order), []), 0, 0, 4, 9, 1, -1, 0, None, True)], size=(4, 9))
    _, _, images = gif.parse(blob)
    assert gif.samples_of(images)[0].tolist() == rows


def test_bad_files():
    for bad in (b"", b"JFIF", b"GIF89a\1"):
        with pytest.raises(ValueError):
            gif.parse(bad)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stored = gif.store_texts(docs)
    got = {r.doc_id: r for r in gif.features(stored).collect()}
    for r in docs.collect():
        raw = r.text.encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        x = got[r.doc_id]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    n = {r.doc_id: r["count"] for r in gif.frames(stored).groupBy("doc_id").count().collect()}
    assert all(n[k] == -(-x.payload_bytes // (192 * 64)) for k, x in got.items())


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "m"), (1, "", "m"), (2, "é" * 96, "n"), (3, "x" * 40_000, "o")], "doc_id int, text string, media string")
    got = sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256) for r in gif.features(gif.store_texts(df)).collect())
    pad = hashlib.sha256(b" " * 192).hexdigest()
    assert got[:2] == [(1, 0, 192, pad)] * 2 and got[2][:3] == (2, 192, 192) and got[3][2] == 40_128
    one = gif.frames(gif.store_texts(df.where("doc_id = 2"))).first()
    assert (one.frame, one.start_ms, one.delay_ms, one.width, one.height) == (0, 0, 40, 192, 1) and sum(one.red) == 192
    assert gif.features(gif.store_texts(df.limit(0))).collect() == [] == gif.frames(gif.store_texts(df.limit(0))).collect()


def test_broken_files_are_rows(spark):
    whole = gif.encode(b"a" * 384)
    at = whole.index(b"\x2c") + 10
    stream = whole[:at] + bytes([whole[at], 3, 0xFF, 0xFF, 0xFF, 0]) + b"\x3b"
    media = [whole, None, b"", b"JFIF", whole[:20], stream, whole, whole[:-3]]
    df = spark.createDataFrame([(k, 384, x) for k, x in enumerate(media)], "doc_id long, n_bytes long, media binary").coalesce(1)
    got = {r.doc_id: r for r in gif.features(df).collect()}
    assert len(got) == len(media)
    assert [k for k, r in got.items() if r.error is None] == [0, 6]
    assert got[0].payload_sha256 == got[6].payload_sha256 == hashlib.sha256(b"a" * 384).hexdigest()
    bad = [r for r in got.values() if r.error is not None]
    assert all(r.n_bytes == 384 and r.payload_sha256 is None and r.feature is None for r in bad)
    shown = gif.frames(df).collect()
    assert sorted((r.doc_id, r.frame is None, r.error is None) for r in shown) == sorted((k, r.error is not None, r.error is None) for k, r in got.items())
