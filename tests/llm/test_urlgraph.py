import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from outpost.llm import urlgraph
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for v, r in urlgraph.RULES:
        h, p = r[: r.index("/")], r[r.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(r) > len(best[1])):
            best = (v, r)
    return host, path, best


def brute_spread(edges, seeds, damping, rounds):
    out = defaultdict(float)
    for (s, _), w in edges.items():
        out[s] += w
    score = dict(seeds)
    if not edges:
        return {k: (1 - damping) * v for k, v in seeds.items()}
    for _ in range(rounds):
        new = {k: (1 - damping) * v for k, v in seeds.items()}
        for (s, d), w in edges.items():
            if s in score:
                new[d] = new.get(d, 0) + damping * score[s] * w / out[s]
        score = new
    return score


def test_rules_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    got = urlgraph.judge(pages).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, best = brute_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        if best:
            assert r.verdict == best[0]


LINKED = [
    (1, "http://good.com/a", '<a href="http://mid.org/x">m</a><a href="/own">o</a><a href=//mid.org/y>'),
    (2, "http://mid.org/", '<a class="k" HREF=\'https://far.org/?q\'>f</a>'),
    (3, "http://shady.org/", '<a href="http://bad.net/es/1">b</a><a href="http://bad.net/es/2">b</a>'),
    (4, "http://bad.net/es/1", ""),
    (5, "http://feeds.org/", '<a href="http://shady.org/">s</a>'),
    (6, "http://far.org/", None),
    (7, None, '<a href="http://mid.org/">'),
    (8, "no scheme", None),
    (8, "no scheme", None),
    (9, "HTTP://WWW.Example.COM/en/1?x", None),
]


def test_propagation(spark):
    df = spark.createDataFrame(LINKED, "page_id int, url string, html string").withColumn("score", F.lit(1)).withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in urlgraph.judge(df).collect()}
    assert got[1].verdict == "allow" and got[4].verdict == "block" and got[9].rule == "www.example.com/en/" and got[9].host == "www.example.com"
    assert [got[k].verdict for k in (3, 5)] == ["block", "block"], "distrust runs against links"
    assert [got[k].verdict for k in (2, 6, 7, 8)] == ["allow"] * 4
    assert (got[8].host, got[8].path, got[8].rule) == ("", "", None)
    edges = Counter({("good.com", "mid.org"): 2, ("mid.org", "far.org"): 1, ("shady.org", "bad.net"): 2, ("feeds.org", "shady.org"): 1, ("", "mid.org"): 1})
    trust = brute_spread(edges, {"good.com": 0.5, "www.example.com": 0.5}, 0.85, urlgraph.ROUNDS)
    distrust = brute_spread({(d, s): w for (s, d), w in edges.items()}, {"bad.net": 1.0}, 0.85, urlgraph.ROUNDS)
    for r in got.values():
        assert r.trust == pytest.approx(2 * trust.get(r.host, 0), abs=1e-9)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=1e-9)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id int, url string, html string")
    assert urlgraph.judge(df).collect() == []
    assert urlgraph.judge(spark.createDataFrame([(1, None, None)], df.schema)).first().verdict == "allow"


def linked(spark, links, schema="page_id int, url string, html string"):
    """One page a host, ``links`` from host to hosts."""
    hosts = sorted({*links, *(d for to in links.values() for d in to)})
    page = lambda h: f"http://{h}/es/" if h.endswith(".net") else f"http://{h}/"
    rows = [(k, page(h), "".join(f'<a href="{page(d)}">' for d in links.get(h, []))) for k, h in enumerate(hosts)]
    return {r.host: r for r in urlgraph.judge(spark.createDataFrame(rows, schema)).collect()}


def converged(links, seeds, back=False):
    """The fixed point, by a dense solution."""
    hosts = sorted({*links, *(d for to in links.values() for d in to)})
    at, m = {h: i for i, h in enumerate(hosts)}, np.zeros((len(hosts), len(hosts)))
    for s, to in links.items():
        for d in to:
            m[(at[s], at[d]) if back else (at[d], at[s])] += 1
    m = m / np.maximum(m.sum(axis=0), 1)
    score = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * np.array([float(h in seeds) for h in hosts]))
    return dict(zip(hosts, score, strict=True))


def test_long_paths_converge(spark):
    links = {f"h{k:02}.org": [f"h{k - 1:02}.org"] for k in range(2, 13)} | {"h01.org": ["bad.net"]}
    got = linked(spark, links)
    assert [got[f"h{k:02}.org"].verdict for k in range(1, 13)] == ["block"] * 6 + ["allow"] * 6
    for h, want in converged(links, {"bad.net"}, back=True).items():
        assert got[h].distrust == pytest.approx(want, abs=2e-6)


def test_cycles_converge(spark):
    rng = random.Random(3)
    hosts = [*(f"c{k}.com" for k in range(3)), *(f"b{k}.net" for k in range(3)), *(f"o{k}.org" for k in range(20))]
    links = {h: [d for d in rng.sample(hosts, 3) if d != h] for h in hosts}
    got = linked(spark, links)
    trust = converged(links, {h for h in hosts if h.endswith(".com")})
    distrust = converged(links, {h for h in hosts if h.endswith(".net")}, back=True)
    for h in hosts:
        assert (got[h].trust, got[h].distrust) == pytest.approx((trust[h], distrust[h]), abs=2e-6)


def test_link_farm(spark):
    """Many hosts around one blocked seed, hosts behind them, and bystanders that link to it among others."""
    farm = [f"f{k:02}.org" for k in range(40)]
    links = {f: ["bad.net"] for f in farm} | {f"g{k}.org": farm[:5] for k in range(10)}
    links |= {"wide.org": ["bad.net", *(f"n{k}.org" for k in range(9))], "good.com": ["known.org"], "known.org": ["bad.net", "n1.org", "n2.org"]}
    got = linked(spark, links)
    assert {got[f].verdict for f in farm} == {"block"} and {got[f"g{k}.org"].verdict for k in range(10)} == {"block"}
    assert [got[h].verdict for h in ("wide.org", "known.org", "n1.org", "good.com", "bad.net")] == ["allow"] * 4 + ["block"]
