"""URL filters with link-graph propagation.

Rules (host and path prefix) judge the urls they fit. For the others, trust spreads from trusted seed hosts
along links (personalised PageRank) and distrust spreads from blocked seed hosts against them, from a link's
target to its page. A host is blocked if its distrust is above ``ratio`` times its trust, and if its distrust or
its exposure is above a floor. Distrust is shared among all hosts that link to a host, so it shrinks as they
grow in number; exposure is what of a walk from the host along its own links ends at blocked seeds, and doesn't.

Host edges are counted before they are spread: pages of one host that link to the same host make one edge
with a weight, summed in part before the shuffle, so a host with a third of all pages or links is a few rows.
Each round is one join on the source and one sum on the target, also in part first; skewed sources are split
by adaptive execution, and the scores are written to the shared folder from time to time to cut the lineage.
Each seed starts with the score 1, and rounds go on until the scores change by no more than a tolerance. Only
sums of the scores reach the driver.

Defined results. A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged
as the host ``''``. A null html has no links. Links without a host are links within the page's host and
carry nothing to others, so they are left out. Very long pages are searched whole, once. Repeated pages count as
often as they are given; each gets a row. A host whose judged pages have as many of one verdict as of the other
is no seed; distrust that ties with trust doesn't block. Without pages there are no rows. Other columns are not
kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from outpost.llm.store import write_table
from outpost.operators.joins import lookup_join

#: Verdict and rule, the rule's host before its first slash.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
#: Rounds before the change of the scores is first measured.
ROUNDS = 8
#: Scores are spread until their summed change, between two writes, is not above this.
TOLERANCE = 1e-6
#: A host is blocked if its distrust is above RATIO times its trust, and if that or its exposure is above FLOOR.
RATIO = 1.0
FLOOR = 0.05
#: Rounds between two writes of the scores.
WRITE_EVERY = 4

_AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), *_AZ)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        at = r.index("/")
        fits = ((host == r[:at]) | host.endswith("." + r[:at])) & path.startswith(r[at:])
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def link_hosts(html: Column) -> Column:
    """Hosts that a page's links name, with repeats."""
    urls = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?i)<a\\s[^>]*?href\\s*=\\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]*)"), F.lit(1))
    return F.transform(urls, lambda u: F.translate(F.regexp_extract(u, "//([^/?#]*)", 1), *_AZ))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, w``: links between different hosts, counted. pages: ``host, html``."""
    links = pages.select(F.col("host").alias("src"), F.explode(link_hosts(F.col("html"))).alias("dst"))
    return links.where((F.col("dst") != "") & (F.col("dst") != F.col("src"))).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE, by: str = "src") -> DataFrame:
    """Personalised PageRank ``host, score`` over ``edges(src, dst, w)`` from ``seeds(host, seed)``. The score
    that hosts without links would pass on stays with no one, so that scores don't grow with the size of the
    graph.

    With ``by="dst"`` an edge carries its share of what its ``dst`` receives, so that a host gets the mean of
    the scores at its edges and not parts of them; the bound below then holds for each host.

    Rounds start from the seeds' own part, so scores only rise, and their summed change is the change of
    their sum. It shrinks by ``damping`` a round: what is still missing when it is within ``tolerance`` is at
    most ``d / (1 - d)`` of that, ``d`` being the damping of ``WRITE_EVERY`` rounds (1.1 times ``tolerance``)."""
    every = edges.groupBy(by).agg(F.sum("w").alias("all"))
    shares = write_table(edges.join(every, by).select("src", "dst", (F.col("w") / F.col("all")).alias("share")), "shares")
    base = seeds.select("host", ((1 - damping) * F.col("seed")).alias("score"))
    if shares.isEmpty():
        return base
    scores, k, last = base, 0, None
    while True:
        k += 1
        moved = scores.join(shares, scores["host"] == shares["src"]).select(F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        # sums of rounded parts, so that they don't depend on the order of rows
        scores = moved.unionByName(base).groupBy("host").agg((_rounded("score") / F.lit(1e15)).cast("double").alias("score"))
        if k % WRITE_EVERY == 0:
            scores = write_table(scores, "scores")
            if k >= rounds:
                total = scores.agg(_rounded("score").alias("all")).first()["all"] or 0
                if last is not None and abs(total - last) <= tolerance * 1e15:
                    return scores
                last = total


def _rounded(score: str) -> Column:
    return F.sum(F.round(F.col(score) * 1e15).cast("decimal(38,0)"))


def host_verdicts(pages: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, ratio: float = RATIO, floor: float = FLOOR, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust, exposure, blocked`` for every host that holds a score. pages: ``host, html, verdict``,
    the verdict of a rule or null. A host is a seed by the verdict that most of its judged pages have."""
    edges = write_table(host_edges(pages), "edges")
    votes = pages.groupBy("host").agg(F.sum(F.when(F.col("verdict") == "allow", 1).when(F.col("verdict") == "block", -1).otherwise(0)).alias("vote"))
    votes = write_table(votes.where("vote <> 0"), "votes")
    one = F.lit(1.0).alias("seed")
    trust = spread(edges, votes.where("vote > 0").select("host", one), damping, rounds, tolerance)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    distrust = spread(back, votes.where("vote < 0").select("host", one), damping, rounds, tolerance)
    exposure = spread(back, votes.where("vote < 0").select("host", one), damping, rounds, tolerance, by="dst")
    both = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
    both = both.join(exposure.withColumnRenamed("score", "exposure"), "host", "left")
    both = both.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"), F.coalesce("exposure", F.lit(0.0)).alias("exposure"))
    return both.withColumn("blocked", (F.col("distrust") > ratio * F.col("trust")) & (F.greatest("distrust", "exposure") > floor))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, **method: float) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every row of ``pages(page_id, url, html)``."""
    p = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "verdict": verdict})
    hosts = write_table(host_verdicts(p, **method), "hosts")
    out = lookup_join(p.drop("html"), hosts, ["host"], "left")
    own = F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def oracle(rules: Sequence[tuple[str, str]] = RULES, damping: float = DAMPING, ratio: float = RATIO, floor: float = FLOOR, hops: int = 150) -> str:
    """SQL for the rows of ``judge`` with scores rounded to four digits. It sums the score by the number of links
    walked, up to ``hops``, beyond which ``damping ** hops`` is left (2.6e-11)."""
    lower = lambda x: f"translate({x}, '{_AZ[0]}', '{_AZ[1]}')"
    link = "<[aA][\\t-\\r ][^>]*?[hH][rR][eE][fF][\\t-\\r ]*=[\\t-\\r ]*[\"'']?((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^\"''\\t-\\r >]*)"
    values = ", ".join(f"('{v}', '{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}')" for v, r in rules)
    return f"""with recursive rules(verdict, rule, host, path) as (values {values}),
    p as materialized (select row_number() over () as id, page_id, html, {lower("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
    fits as (select id, max({{'n': length(rule), 'rule': rule, 'verdict': verdict}}) as best from p join rules r
        on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path) group by id),
    judged as materialized (select p.*, best.rule as rule, best.verdict as verdict from p left join fits using (id)),
    links as (select host as src, unnest(regexp_extract_all(html, '{link}', 1)) as url from judged),
    edges as materialized (select src, {lower("regexp_extract(url, '//([^/?#]*)', 1)")} as dst, count(*) as w from links group by all having dst <> '' and dst <> src),
    votes as (select host, sum(case verdict when 'allow' then 1 when 'block' then -1 else 0 end) as vote from judged group by host having vote <> 0),
    hop as materialized (select 'trust' as kind, src as a, dst as b, w / sum(w) over (partition by src) as share from edges
        union all select 'distrust', dst, src, w / sum(w) over (partition by dst) from edges
        union all select 'exposure', dst, src, w / sum(w) over (partition by src) from edges),
    walk(kind, host, k, m) as (select kind, host, 0, cast({1 - damping!r} as double) from votes
        join (values ('trust', 1), ('distrust', -1), ('exposure', -1)) as kinds(kind, side) on sign(vote) = side
        union all select kind, b, k + 1, sum({damping!r}::double * m * share) from (select walk.kind, b, k, m, share from walk join hop on hop.kind = walk.kind and hop.a = walk.host where k < {hops}) group by kind, b, k),
    score as (select host, coalesce(sum(m) filter (where kind = 'trust'), 0) as trust, coalesce(sum(m) filter (where kind = 'distrust'), 0) as distrust,
        coalesce(sum(m) filter (where kind = 'exposure'), 0) as exposure from walk group by host)
    select page_id, host, path, rule, coalesce(verdict, case when distrust > {ratio!r} * trust and greatest(distrust, exposure) > {floor!r} then 'block' else 'allow' end) as verdict,
        round(coalesce(trust, 0), 4) as trust, round(coalesce(distrust, 0), 4) as distrust from judged left join score using (host)"""
