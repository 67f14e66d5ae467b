"""One query per operator, over its whole table, in the shapes the contracts fix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklore.llm import (
    exact_dedup,
    jaccard_join,
    mixing,
    packing,
    pii,
    pivot_search,
    prefix_trie,
    quality,
    sharding,
    term_pipeline,
    toxicity,
    url_filter,
    warc,
)
from stacklore.llm.common import read

SHARDS = 24
# Fixed rules of the URL query.
RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    voters = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, voters).select(
        "doc_id", toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return pivot_search.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(read(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_components(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", toxicity.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "matches",
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(read(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.col("copies").cast("long").alias("copies"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.document_keys(read(spark, sf_dir, "documents"))
    return sharding.shard_rows(rows, ["doc_id", "text_crc32", "size"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES)


def op13_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality": op2_quality,
    "op3_pivot_search": op3_pivot_search,
    "op4_packing": op4_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_url_filter": op12_url_filter,
    "op13_term_pipeline": op13_term_pipeline,
}
