"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word n-grams: a trusted target (the documents labelled good)
and the raw corpus (all documents). The score of a document is the sum of its n-grams' log ratios over their
number; a document is kept if its score is at least a fixed threshold. Bucket scores are whole millionths, so
that sums don't depend on the order of rows.

DataFrame functions only. Texts are read once; their statistics and hashed n-grams (two bytes each) are
written to the shared folder and read again for counting and scoring. Counting groups by bucket, of which
there are ``buckets``, with partial sums before the shuffle. The ratios are one array of that size, fixed by a
parameter, which a scalar subquery hands to all tasks: rows are scored where they are, without a join or a
shuffle.

Defined results. Null and empty texts have no words, all statistics 0, and are judged by the base rules
alone. A text of one word has no pair. Very long texts are worked on whole, one row at a time, in memory in
proportion to the row. Repeated ids are separate rows, each judged. A score equal to the threshold is kept, so
rows that tie have the same verdict. Without target labels, or without documents, the ratio is
0 everywhere and keeps what the base rules keep. A target of few n-grams is pulled towards even
shares by the smoothing, so a handful of labels beside a large corpus rejects nearly all documents. Labels with
null ids or values are ignored; labels that repeat count once. ``judge`` neither reads nor keeps other columns
of the input; ``keep_good`` keeps all of them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from outpost.llm.store import write_table
from outpost.llm.words import WORD, word_array

BUCKETS = 1 << 14
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Pseudo-count of each bucket.
SMOOTHING = 1.0
#: Labelled documents that the target's model is fitted on, at most.
TARGET_ROWS = 20_000
SEED = 20240509
#: Least mean log ratio, in millionths.
THRESHOLD = -100_000
SYMBOLS = "[#*$%&|<>]"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once a row: inside a lambda, an expression would be worked
    out again for each element."""
    return F.get(F.transform(F.array(value), use), 0)


def repeated_words(ws: Column, n: int = WINDOW) -> Column:
    """How many words lie in an ``n``-word window that occurs twice or more in the same array."""
    count = F.size(ws) - (n - 1)
    hashes = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(n)]))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-n).alias("last"))

    def step(acc: Column, start: Column) -> Column:
        return F.struct((acc["sum"] + F.least(F.lit(n), start - acc["last"])).cast("long").alias("sum"), start.alias("last"))

    def starts(at: Column) -> Column:
        """Starts of windows whose hash stands beside an equal one in the sorted array."""
        equal = lambda x, i, d: F.coalesce(F.get(at, i + d)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(at, lambda x, i: equal(x, i, -1) | equal(x, i, 1)), lambda x: x["i"])

    def covered(hs: Column) -> Column:
        sorted_hs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(F.array_sort(bound(sorted_hs, starts)), zero, step, lambda acc: acc["sum"])

    # a text without repeated windows, the usual case, needs no sort
    found = bound(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)))
    return F.when(count >= 2, found).otherwise(0).cast("long")


def ngram_buckets(ws: Column, buckets: int = BUCKETS) -> Column:
    """Hashed buckets of all words and all pairs of neighbouring words, as shorts."""
    bucket = lambda *w: F.pmod(F.xxhash64(*w), F.lit(buckets)).cast("short")
    firsts = F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0)))
    return F.concat(F.transform(ws, lambda w: bucket(w)), F.transform(firsts, lambda w, i: bucket(w, F.get(ws, i + 1))))


def statistics(docs: DataFrame, buckets: int = BUCKETS, keep_rows: bool = False) -> DataFrame:
    """``doc_id`` with the text statistics and ``grams`` of every row of ``docs(doc_id, text)``, and with the
    whole ``row`` if asked for."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = [F.struct(*docs.columns).alias("row")] if keep_rows else []
    d = docs.select("doc_id", text.alias("text"), *row)

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
            ngram_buckets(ws, buckets).alias("grams"),
        )

    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    return d.select(
        "doc_id",
        *[F.col("row") for _ in row],
        bound(word_array(F.col("text")), of_words).alias("of_words"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "of_words.n_words", "of_words.word_chars", "n_symbols", "n_dup_lines", "of_words.n_repeat_words", "of_words.grams", *[F.col("row") for _ in row])


def log_ratios(stats: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``bucket, ratio`` of every bucket: log of the target's over the corpus's smoothed share, in millionths. The target's
    counts come from at most ``target_rows`` labelled documents, those first by a seeded hash; the corpus's
    from all documents."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    good = good.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(target_rows).withColumn("good", F.lit(1))
    d = stats.select("doc_id", "grams").join(F.broadcast(good), "doc_id", "left")
    g = d.select(F.explode("grams").alias("bucket"), F.coalesce("good", F.lit(0)).cast("long").alias("good"))
    counts = g.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("n_good"))
    every = stats.sparkSession.range(buckets).select(F.col("id").cast("short").alias("bucket"))
    counts = write_table(every.join(counts, "bucket", "left").fillna(0), "counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_good").alias("good")).first()
    if not total["good"]:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))
    share = lambda c, all_: (F.col(c) + smoothing) / (all_ + smoothing * buckets)
    return counts.select("bucket", F.round(F.log(share("n_good", total["good"]) / share("n", total["n"])) * 1_000_000).cast("long").alias("ratio"))


def _judged(docs: DataFrame, labels: DataFrame, buckets: int, threshold: int, keep_rows: bool) -> DataFrame:
    stats = write_table(statistics(docs, buckets, keep_rows), "quality", compression="zstd")
    ratios = log_ratios(stats, labels, buckets)
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "ratio")))
    array = ratios.agg(F.transform(in_order, lambda x: x["ratio"]))
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda acc, g: acc + F.get(F.col("__ratios"), g.cast("int")))
    score = F.when(F.size("grams") > 0, F.expr("__sum div size(grams)"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    out = stats.withColumn("__ratios", array.scalar()).withColumn("__sum", total).withColumns({"base_failed": failed, "score": score})
    out = out.drop("__ratios", "__sum", "grams")
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0)) >= threshold))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: int = THRESHOLD) -> DataFrame:
    """Statistics, base rules, ``score`` (mean log ratio in millionths, null without words) and ``kept``."""
    return _judged(docs, labels, buckets, threshold, False)


def keep_good(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept; all columns stay."""
    return _judged(docs, labels, buckets, threshold, True).where("kept").select("row.*")
