"""Queries of the training-data operators, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from outpost.llm import bpe, gif, jaccard, mixing, pii, quality, suffix, tokens, urlgraph, warc, words
from outpost.sources import read_table


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(read_table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", words.word_count(F.col("text")).alias("size"))
    out = mixing.mix(docs, mixing.cycled_weights(read_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op3_link_graph_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urlgraph.judge(read_table(spark, sf_dir, "pages"))
    # as far as scores that are spread to a tolerance are sure
    return out.withColumns({c: F.round(c, 4) for c in ("trust", "distrust")})


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.features(gif.store_texts(read_table(spark, sf_dir, "documents")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.files(spark)
    tokens.write(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.checksums(tokens.read(spark, path))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_warc_derivatives, op2_mix_sources, op3_link_graph_urls, op4_suffix_dedup, op5_gif_media, op6_bpe, op7_token_files, op8_ngram_jaccard_join, op9_quality_rules, op10_personal_data)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_derivatives": warc.oracle(), "op3_link_graph_urls": urlgraph.oracle()}
