"""WARC derivatives: from each response a linked metadata record and a plain-text conversion record.

Both derivatives refer to the response by its record id, carry its target URI, date and source headers
(payload type and digest) and have digests of their own. Ids are UUIDs made from the response's URI and
bytes (and its record id, if it has one), so a rerun makes the same records.

One pass over the pages, no shuffle; column expressions, but for the visible text, which an Arrow function makes
in small batches, reading each page a fixed number of times whatever it holds.

Defined results. A null html is an empty payload, a null url an empty URI. Repeated rows give repeated
records. Pages with the same URI and bytes get the same ids, as they are the same response. Markup that never
ends (``<script>`` without its own end tag, ``<!--`` without ``-->``, ``<`` without ``>``) stays as text; what the
page holds after it is still read as markup. Line ends in a URI are percent-encoded, in other header values they
become spaces, so that no value can add lines to a record. Very long pages are worked on whole, one at a time.
Other columns of the input are not kept.
"""

from __future__ import annotations

import html as markup
import html.entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from outpost.llm.store import small_batches

CAPTURED = "2024-01-01T00:00:00Z"
STATUS, TYPE = "200", "text/html"
#: Columns of the pages that hold the response's own headers: its record id, date, status, content type, digest.
OWN = ("response_id", "captured", "status", "content_type", "payload_digest")

#: Elements whose content isn't text, and tags that end a line.
HIDDEN = ("script", "style", "noscript", "template")
BLOCKS = ("br", "/p", "/div", "/li", "/h[1-6]", "/tr", "/title", "/article", "/section", "/ul", "/ol", "/table")

_FLAGS = re.IGNORECASE | re.ASCII
_HIDDEN = re.compile(rf"<({'|'.join(HIDDEN)})\b", _FLAGS)
_END = {k: re.compile(rf"</{k}[\t\n\f\r ]*>", _FLAGS) for k in HIDDEN}
_BLOCK = re.compile(rf"<(?:{'|'.join(BLOCKS)})\b[^<>]*>", _FLAGS)
_TAG = re.compile("<[^<>]*>")
#: A character reference as HTML reads it in text, named or numeric; some may lack the semicolon.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")


def resolved(text: str) -> str:
    """``text`` with all references of HTML resolved, once. No-break spaces given by reference become spaces."""
    return _REFERENCE.sub(lambda m: markup.unescape(m[0]).replace("\xa0", " "), text) if "&" in text else text


def _without_comments(text: str) -> str:
    parts, done = [], 0
    while (start := text.find("<!--", done)) >= 0 and (end := text.find("-->", start + 4)) >= 0:
        parts += [text[done:start], " "]
        done = end + 3
    return "".join(parts) + text[done:]


def _without_hidden(text: str) -> str:
    parts, done, at = [], 0, 0
    endless: set[str] = set()  # elements that don't end in what is left, so that nothing is searched twice
    while m := _HIDDEN.search(text, at):
        at, kind = m.end(), m[1].lower()
        if kind in endless:
            continue
        opened = text.find(">", at)
        end = _END[kind].search(text, opened + 1) if opened >= 0 else None
        if end is None:
            endless.add(kind)
            continue
        parts += [text[done : m.start()], " "]
        done = at = end.end()
    return "".join(parts) + text[done:]


def visible(page: str) -> str:
    """Visible text of a page: blocks on lines of their own, references resolved, white space folded."""
    text = resolved(_TAG.sub("", _BLOCK.sub("\n", _without_hidden(_without_comments(page)))))
    return re.sub(" ?\n[ \n]*", "\n", re.sub("[ \t\r\f]+", " ", text)).strip(" \n")


def _visible(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else visible(p) for p in pages.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    return F.arrow_udf(_visible, "string")(html)


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:…>`` of version 3 from the MD5 of the parts."""
    m = F.md5(F.concat_ws("\n", *parts))
    variant = F.translate(F.substring(m, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    cuts = (F.substring(m, 1, 8), F.substring(m, 9, 4), F.concat(F.lit("3"), F.substring(m, 14, 3)), F.concat(variant, F.substring(m, 18, 3)), F.substring(m, 21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def one_line(value: Column) -> Column:
    return F.regexp_replace(value, "[\\r\\n]+", " ")


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def record(kind: str, header: list[tuple[str, Column]], block: Column) -> Column:
    """A whole WARC record as text."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}")]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in header]
    lines += [F.concat(F.lit("WARC-Block-Digest: "), digest(block)), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))


def _own(pages: DataFrame, name: str) -> Column:
    """A column of ``OWN`` as text; null if the pages lack it."""
    if name not in pages.columns:
        return F.lit(None).cast("string")
    kind, value = pages.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        value, kind = F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz")), T.TimestampNTZType()
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return one_line(value.cast("string"))


def derive(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """``pages(page_id, url, html)`` to two rows each: ``page_id, kind, record_id, refers_to, target_uri,
    source_type, source_digest, block_digest, n_bytes, block, record``. Columns of ``OWN`` are kept where the
    pages have them; a column or value that is missing is made from the page (id, digest) or constant."""
    small_batches(pages.sparkSession)
    url, html = F.coalesce(F.col("url"), F.lit("")), F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", url.alias("url"), html.alias("html"), *[_own(pages, name).alias(name) for name in OWN])
    p = p.withColumns({"source_digest": F.coalesce("payload_digest", digest(F.col("html"))), "text": plain_text(F.col("html"))})
    p = p.withColumn("response", F.coalesce("response_id", record_id(F.lit("response"), F.col("url"), F.col("source_digest"))))
    p = p.withColumns({"status": F.coalesce("status", F.lit(STATUS)), "source_type": F.coalesce("content_type", F.lit(TYPE)), "date": F.coalesce("captured", F.lit(captured))})
    source_type = F.col("source_type")
    title = F.regexp_replace(F.regexp_extract("html", "(?is)<title[^>]*>([^<]*)</title", 1), "[\\r\\n]+", " ")
    n_links = F.regexp_count(F.col("html"), F.lit("(?i)<a\\s[^>]*href")).cast("string")
    language = F.regexp_extract("html", "(?i)<html[^>]*\\slang=\"([A-Za-z-]*)\"", 1)
    fields = F.concat_ws(
        "\r\n",
        F.concat(F.lit("source-status: "), F.col("status")),
        F.concat(F.lit("source-type: "), source_type),
        F.concat(F.lit("source-length: "), F.octet_length("html").cast("string")),
        F.concat(F.lit("source-digest: "), F.col("source_digest")),
        F.concat(F.lit("title: "), title),
        F.concat(F.lit("language: "), language),
        F.concat(F.lit("outlinks: "), n_links),
        F.lit(""),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain").alias("type"), F.col("text").alias("block")),
    )
    d = p.withColumn("each", F.explode(kinds)).select("page_id", "url", "response", "source_digest", "source_type", "date", "response_id", "each.*")
    # a response with an id of its own is told from others of the same bytes
    d = d.withColumn("id", record_id("kind", "url", "source_digest", "response_id"))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = [
        ("WARC-Record-ID", F.col("id")), ("WARC-Refers-To", F.col("response")), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", F.col("date")),
        ("WARC-Target-URI", uri), ("WARC-Date", F.col("date")), ("X-Source-Content-Type", source_type),
        ("X-Source-Payload-Digest", F.col("source_digest")), ("Content-Type", F.col("type")),
    ]
    whole = F.when(F.col("kind") == "metadata", record("metadata", header, F.col("block"))).otherwise(record("conversion", header, F.col("block")))
    return d.select(
        "page_id", "kind", F.col("id").alias("record_id"), F.col("response").alias("refers_to"), F.col("url").alias("target_uri"),
        "source_type", "source_digest", digest(F.col("block")).alias("block_digest"),
        F.octet_length("block").cast("long").alias("n_bytes"), "block", whole.alias("record"),
    )


def _sql_text(s: str) -> str:
    if s.isprintable():
        return "'" + s.replace("'", "''") + "'"
    return " || ".join(f"chr({ord(c)})" for c in s) or "''"


def _sql_map(pairs: dict) -> str:
    return f"map([{', '.join(k if isinstance(k, str) else str(k) for k in pairs)}], [{', '.join(map(_sql_text, pairs.values()))}])"


def _sql_resolved(text: str) -> str:
    """References resolved in SQL: the text cut at them, each looked up by its name or number. The tables come
    from the names and the rules that Python's own library has."""
    read = lambda ref: markup.unescape(ref).replace("\xa0", " ")
    names = {_sql_text(f"&{n}"): read(f"&{n}") for n in html.entities.html5}
    short = "|".join(sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
    low = {n: read(f"&#{n};") for n in range(161)}
    number = "coalesce(try_cast(case when lower(x[3:3]) = 'x' then '0x' || rtrim(x[4:], ';') else rtrim(x[3:], ';') end as bigint), 1114112)"
    of_number = f"""case when {number} <= 160 then {_sql_map(low)}[{number}]
        when {number} between 55296 and 57343 or {number} > 1114111 then chr(65533)
        when {number} between 64976 and 65007 or {number} % 65536 >= 65534 then '' else chr({number}::int) end"""
    prefix = f"regexp_extract(x, '^&(?:{short})')"
    of_name = f"coalesce({_sql_map(names)}[x], case when {prefix} <> '' then {_sql_map(names)}[{prefix}] || x[length({prefix}) + 1:] else x end)"
    cut = f"regexp_extract_all({text}, '&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&')"
    each = f"list_transform({cut}, lambda x: case when x[1:1] <> '&' or x = '&' then x when x[2:2] = '#' then {of_number} else {of_name} end)"
    return f"case when contains({text}, '&') then array_to_string({each}, '') else {text} end"


def oracle(captured: str = CAPTURED) -> str:
    """The same as SQL for the oracle, of pages without columns of ``OWN``."""
    hidden = "|".join(f"<{k}\\b[^>]*>.*?</{k}[\\t\\n\\f\\r ]*>" for k in HIDDEN)
    steps = [("s", "<!--.*?-->", " "), ("is", hidden, " "), ("i", f"<(?:{'|'.join(BLOCKS)})\\b[^<>]*>", "\n"), ("", "<[^<>]*>", "")]
    tags = "html"
    for flags, pattern, by in steps:
        tags = f"regexp_replace({tags}, '{pattern}', {_sql_text(by)}, 'g{flags}')"
    folded = f"regexp_replace(regexp_replace(unfolded, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', {_sql_text(chr(10))}, 'g')"
    text = f"trim({folded}, ' ' || chr(10))"
    crlf = "chr(13) || chr(10)"
    variant = lambda m: f"translate(substr({m},17,1), '0123456789abcdef', '89ab89ab89ab89ab')"
    uuid = lambda m: f"'<urn:uuid:' || substr({m},1,8) || '-' || substr({m},9,4) || '-3' || substr({m},14,3) || '-' || {variant(m)} || substr({m},18,3) || '-' || substr({m},21,12) || '>'"
    fields = f" || {crlf} || ".join([
        "'source-status: 200'", "'source-type: text/html'", "'source-length: ' || strlen(html)", "'source-digest: ' || source_digest",
        "'title: ' || regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title', 1), '[\\r\\n]+', ' ', 'g')",
        "'language: ' || regexp_extract(html, '(?i)<html[^>]*\\slang=\"([A-Za-z-]*)\"', 1)",
        "'outlinks: ' || len(regexp_extract_all(html, '(?i)<a\\s[^>]*href'))", "''",
    ])
    uri = "replace(replace(url, chr(13), '%0D'), chr(10), '%0A')"
    record_text = f" || {crlf} || ".join([
        "'WARC/1.1'", "'WARC-Type: ' || kind", "'WARC-Record-ID: ' || record_id", "'WARC-Refers-To: ' || refers_to",
        f"'WARC-Refers-To-Target-URI: ' || {uri}", f"'WARC-Refers-To-Date: {captured}'", f"'WARC-Target-URI: ' || {uri}", f"'WARC-Date: {captured}'", "'X-Source-Content-Type: text/html'",
        "'X-Source-Payload-Digest: ' || source_digest", "'Content-Type: ' || case kind when 'metadata' then 'application/warc-fields' else 'text/plain' end",
        "'WARC-Block-Digest: ' || block_digest", "'Content-Length: ' || n_bytes", "''", "block", "''", "''",
    ])
    return f"""
    with p as (select page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages),
    g as (select *, {tags} as tagless from p),
    u as (select *, {_sql_resolved('tagless')} as unfolded from g),
    s as (select *, 'sha256:' || sha256(html) as source_digest, {text} as text from u),
    r as (select *, md5('response' || chr(10) || url || chr(10) || source_digest) as rm from s),
    b as (select page_id, url, source_digest, rm, 'metadata' as kind, {fields} as block from r
          union all select page_id, url, source_digest, rm, 'conversion' as kind, text as block from r),
    i as (select *, md5(kind || chr(10) || url || chr(10) || source_digest) as im, 'sha256:' || sha256(block) as block_digest,
          cast(strlen(block) as bigint) as n_bytes from b),
    j as (select *, {uuid('im')} as record_id, {uuid('rm')} as refers_to from i)
    select page_id, kind, record_id, refers_to, url as target_uri, 'text/html' as source_type, source_digest, block_digest,
           n_bytes, block, {record_text} as record from j
    """
