import hashlib
import html
import html.entities
import re
import time
import uuid

from outpost.llm import warc
from pyspark.sql import functions as F

PAGE = '<html lang="en"><head><title>T &amp; more</title><style>p{}</style><script>var t="</p>";</script></head><body><!-- no --><p>One&nbsp;two<br>three</p><div>4 &lt; 5 &amp;amp;</div><a href="/x">l</a></body></html>'


def test_records(spark):
    df = spark.createDataFrame([(1, "http://h/x", PAGE, "k")], "page_id int, url string, html string, kind string")
    rows = {r.kind: r for r in warc.derive(df).collect()}
    text = rows["conversion"].block
    assert text == "T & more\nOne two\nthree\n4 < 5 &amp;\nl"
    source = "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
    for r in rows.values():
        assert r.source_digest == source and r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        head, block, _ = r.record.split("\r\n\r\n", 2) if r.kind == "conversion" else (r.record.split("\r\n\r\n", 1)[0], r.block, "")
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert fields["WARC-Type"] == r.kind and fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Record-ID"] == r.record_id
        assert int(fields["Content-Length"]) == len(r.block.encode()) == r.n_bytes and fields["X-Source-Payload-Digest"] == source
        assert block == r.block
    assert rows["metadata"].refers_to == rows["conversion"].refers_to != rows["metadata"].record_id != rows["conversion"].record_id
    assert "title: T &amp; more\r\nlanguage: en\r\noutlinks: 1\r\n" in rows["metadata"].block


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", ""), (3, "v", "<script>never ends " + "<p" * 1000), (4, "w", "x" * 300_000)], "page_id int, url string, html string")
    out = warc.derive(df.withColumn("block", F.lit(1))).collect()
    assert len(out) == 10 and all(r.record and r.refers_to for r in out)
    assert {r.block for r in out if r.page_id < 3 and r.kind == "conversion"} == {""}
    assert len({r.record_id for r in out if r.page_id == 2}) == 2
    assert warc.derive(df.limit(0)).collect() == []


def test_all_references_are_resolved(spark):
    named = " ".join(f"&{n}" for n in sorted(html.entities.html5) if n.endswith(";"))
    texts = ["a &copy; b &middot; c&mdash;d &eacute;", "&#8217;&#x27;&#X2014; &#128; &#0; &#xD800;", "&amp;lt; &amp;amp;copy; &amp;#39;", "&copy 1 &notit; &nosuch; & &; &#; AT&T", named]
    df = spark.createDataFrame([(k, "u", f"<p>{t}</p>") for k, t in enumerate(texts)], "page_id int, url string, html string")
    got = {r.page_id: r.block for r in warc.derive(df).collect() if r.kind == "conversion"}
    fold = lambda t: re.sub(" ?\n[ \n]*", "\n", re.sub("[ \t\r\f]+", " ", t.replace("\xa0", " "))).strip(" \n")
    for k, t in enumerate(texts):
        assert got[k] == fold(html.unescape(t))
    assert got[2] == "&lt; &amp;copy; &#39;"


def test_source_headers_are_kept(spark):
    rows = [(1, "u", "<p>x</p>", "<urn:uuid:1>", "2023-05-06 07:08:09", 404, "application/xhtml+xml", "sha1:ABC"), (2, "u", "<p>x</p>", "<urn:uuid:2>", None, None, None, None), (3, "u", "<p>x</p>", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, response_id string, captured string, status int, content_type string, payload_digest string")
    plain = {(r.kind): r.record for r in warc.derive(df.where("page_id = 3").select("page_id", "url", "html")).collect()}
    for at in ("timestamp", "timestamp_ntz", "string"):
        day = F.concat(F.replace("captured", F.lit(" "), F.lit("T")), F.lit("Z")) if at == "string" else F.col("captured").cast(at)
        zone = spark.conf.get("spark.sql.session.timeZone")
        try:
            spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
            out = {(r.page_id, r.kind): r for r in warc.derive(df.withColumn("captured", day)).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        date = "2023-05-05T22:08:09Z" if at == "timestamp" else "2023-05-06T07:08:09Z"
        for kind in ("metadata", "conversion"):
            r = out[1, kind]
            assert (r.refers_to, r.source_type, r.source_digest) == ("<urn:uuid:1>", "application/xhtml+xml", "sha1:ABC")
            assert f"WARC-Date: {date}\r\n" in r.record and "X-Source-Content-Type: application/xhtml+xml\r\nX-Source-Payload-Digest: sha1:ABC\r\n" in r.record
            assert out[2, kind].refers_to == "<urn:uuid:2>" and "WARC-Date: 2024-01-01T00:00:00Z\r\n" in out[2, kind].record
            assert out[3, kind].record == plain[kind] and len({out[k, kind].record_id for k in (1, 2, 3)}) == 3
        assert out[1, "metadata"].block.startswith("source-status: 404\r\nsource-type: application/xhtml+xml\r\n")
        assert out[2, "metadata"].block.startswith("source-status: 200\r\nsource-type: text/html\r\n")


def test_markup_is_read_once():
    began = time.process_time()
    for piece in ("<!--", "<script>", "<script ", "<style><script>", "<br ", "<!-- -->x", "</script", "<", "&", "&#", "<script>x</style>"):
        text = piece * (5_000_000 // len(piece))
        assert isinstance(warc.visible(text), str)
    assert time.process_time() - began < 2 * 11


def test_hidden_elements_end_with_their_own_tag():
    assert warc.visible("a<script>x</style>y</script\n>b<style>z</STYLE >c<script d>e") == "a b ce"
    assert warc.visible("a<script <style>b</style>c") == "a<script c"
    assert warc.visible("a<!-- b <!-- c --> d --> e <!-- f") == "a d --> e <!-- f"


def test_no_value_adds_lines(spark):
    rows = [(1, "http://h/\r\nWARC-Type: response", "<title>a\r\nb</title>x", "t/x\r\nEvil: 1")]
    for r in warc.derive(spark.createDataFrame(rows, "page_id int, url string, html string, content_type string")).collect():
        head = r.record.split("\r\n\r\n")[0].split("\r\n")
        assert len([h for h in head if h.startswith("WARC-Type")]) == 1 and not any(h.startswith("Evil") for h in head)
        assert "WARC-Target-URI: http://h/%0D%0AWARC-Type: response" in head and "X-Source-Content-Type: t/x Evil: 1" in head
        assert "WARC-Refers-To-Date: 2024-01-01T00:00:00Z" in head
        for i in (r.record_id, r.refers_to):
            assert uuid.UUID(i[10:-1]).version == 3 and uuid.UUID(i[10:-1]).variant == uuid.RFC_4122
