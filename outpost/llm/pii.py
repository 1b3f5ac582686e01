"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, URL schemes, plus signs and words that announce
an identifier. Small deterministic parsers expand each anchor to both sides and validate what they find.
Numbers have no anchor but their digits; they are found by linear patterns and validated (Luhn, octets,
digit counts).

Kinds, in the order they are listed: ``email, ip, card, phone`` (the base kinds), then the method's own
``url`` (a URL with user info), ``account`` (an IBAN with a right checksum, or the number after an account
cue), ``secret`` (the value after a token, key or password cue). Spans may overlap; an own span that lies wholly
inside another span is dropped; of own spans that tie, with the same start and end, the kind listed first stays.

Every text, however long, is scanned whole, in time linear in its length. Tasks hold one Arrow batch; no shuffle.

Defined results. A null or empty text has no spans. Repeated ids are separate rows. Positions are code
points, end exclusive. Other columns of the input are not kept by the query; ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from outpost.llm.store import small_batches

#: Kinds in the order of the listing.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
#: Anchors by the parser that they start. Words are matched in lower case.
ANCHORS = {
    "email": ("@",),
    "phone": ("+",),
    "url": ("://",),
    "account": ("iban", "account", "acct", "konto", "cuenta", "compte"),
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_LETTER = re.compile("[A-Za-z]")
_USER_URL = re.compile(r"[^\s/?#@\x00-\x1f]++@[A-Za-z0-9.-]++(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*+)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,33}(?![0-9])")
_ACCOUNT_GAP = re.compile(r"(?:\s|number|no\.?|nr\.?|#|:|=|-){0,8}")
_SECRET_GAP = re.compile(r"[\"']?\s{0,4}[:=]\s{0,4}[\"']?")
_SECRET = re.compile(r"[A-Za-z0-9+/_=.-]{12,}+")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in ANCHORS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def _octets(m: re.Match) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _lower(text: str) -> str:
    """Lower case without a change of positions."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def anchors(text: str) -> dict[str, list[tuple[int, int]]]:
    """Start and end of every anchor, by kind, in order."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in ANCHORS}
    for last, (kind, n) in _automaton().iter(_lower(text)):
        found[kind].append((last + 1 - n, last + 1))
    return found


def _emails(text: str, at: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    free = 0
    for p, after in at:
        if p < free:
            continue
        start = p
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < p and (m := _DOMAIN.match(text, after)):
            yield start, m.end()
            free = m.end()
        else:
            # what stands before this sign can't begin a later address: the sign is no local character
            free = max(free, after)


def _phones(text: str, at: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    free = 0
    for p, _ in at:
        if p >= free and (m := _PHONE.match(text, p)):
            free = m.end()
            if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                yield p, free


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _urls(text: str, at: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    free = 0
    for p, after in at:
        if p < free:
            continue
        start = p
        while start > free and text[start - 1] in _SCHEME:
            start -= 1
        # the colon of an earlier sign is no character of a scheme, so that nothing is read back twice
        if (scheme := _LETTER.search(text, start, p)) and (m := _USER_URL.match(text, after)):
            free = m.end()
            yield scheme.start(), free


def _word_before(text: str, p: int) -> bool:
    return p > 0 and (text[p - 1].isalnum() or text[p - 1] == "_")


def _accounts(text: str, at: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    for p, after in at:
        if _word_before(text, p):
            continue
        start = _ACCOUNT_GAP.match(text, after).end()
        if m := _IBAN.match(text, start):
            # the longest group of whole blocks that has a right checksum
            for end in range(m.end(), start + 14, -1):
                if text[end - 1] != " " and _iban(text[start:end]):
                    yield start, end
                    break
        elif start > after and (m := _NUMBER.match(text, start)):
            yield m.span()


def _letter_before(text: str, p: int) -> bool:
    """As ``_word_before``, for cues that may end a longer name: ``DB_PASSWORD``, ``access_token``."""
    return p > 0 and text[p - 1].isalnum()


def _secrets(text: str, at: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    free = 0
    for p, after in at:
        # a value that starts within the last run ends with it, so that no run is read twice
        if not _letter_before(text, p) and (gap := _SECRET_GAP.match(text, after)) and gap.end() >= free and (m := _SECRET.match(text, gap.end())):
            free = m.end()
            if any(c.isdigit() for c in m[0]):
                yield m.span()


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind as listed, then start."""
    if not text:
        return []
    at = anchors(text)
    base = {
        "email": list(_emails(text, at["email"])),
        "ip": [m.span() for m in _IP.finditer(text) if _octets(m)],
        "card": list(_cards(text)),
        "phone": list(_phones(text, at["phone"])),
    }
    out = [(k, s, e) for k in BASE for s, e in base[k]]
    own = {"url": _urls, "account": _accounts, "secret": _secrets}
    out += [(kind, s, e) for kind, parse in own.items() for s, e in sorted(parse(text, at[kind]))]
    inside, reach = set(), 0
    for kind, s, e in sorted(out, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if e <= reach and kind not in BASE:
            inside.add((kind, s, e))
        reach = max(reach, e)
    return [x for x in out if x not in inside]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def _masked(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    if not found:
        return text
    merged: list[list] = []
    for k, s, e in sorted(found, key=lambda x: (x[1], -x[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([k, s, e])
    parts, last = [], 0
    for k, s, e in merged:
        parts += [text[last:s], f"<{k}>"]
        last = e
    return "".join(parts) + text[last:]


_REPORT = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{k}", T.LongType()) for k in BASE]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def find(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to counts of the base kinds, a digest of the base spans, and all spans."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text"):
                found = spans(text.as_py())
                base = [x for x in found if x[0] in BASE]
                kinds = [x[0] for x in base]
                rows.append((*[kinds.count(k) for k in BASE], hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [b.column("doc_id").cast(pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in _REPORT])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _REPORT)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; all columns stay."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_masked(t, spans(t)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
