"""From raw documents to token ids: quality rules, near duplicates, personal data, mixing, BPE.

Every stage takes what its predecessor kept, as Parquet, and returns the columns of ``documents`` (the last:
token ids). Empty tables give empty tables."""

from __future__ import annotations

import public_tokenizers
from outpost.llm import bpe, jaccard, mixing, pii, quality
from outpost.llm.store import write_table
from outpost.sources import read_table
from pyspark.sql import DataFrame, SparkSession


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the log-likelihood ratio reject go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out so that sources come to their target weights."""
    return mixing.take(docs, mixing.cycled_weights(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; the digest is of the text decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mix_sources),
    ("BPE", encode),
]

#: The likelihood ratio, the similarity join and BPE are out of reach of SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
