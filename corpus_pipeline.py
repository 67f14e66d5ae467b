"""Corpus pipeline: filter, deduplicate, mix and pack the documents table.

Every stage reads what the one before wrote, all of it, and all but the last return the
columns of `documents`. Toxic documents go; of exact copies one stays; of each group of near
copies one stays; sources are repeated or thinned out to their target weights; what is left is
packed into token sequences, one row per piece.

Empty tables pass through as empty tables; nulls, empty texts, repeated rows and other columns
are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stacklore.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from stacklore.llm.common import read, ready
from stacklore.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, scores below the threshold."""
    lexicon = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, lexicon)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return jaccard_join.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned weights and a tokenizer cannot be written as SQL. A brute-force version of all stages is open.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
