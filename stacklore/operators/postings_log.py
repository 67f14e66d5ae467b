"""An inverted index kept as a log: a refresh writes what changed, not the index.

An index folder holds, per version, the documents inserted, updated or deleted (`docs`), the
term counts of the new texts (`postings`), and by how much each term's number of documents and
the number of all documents moved (`terms`, the latter under a NULL term). Only changed texts
are tokenised; nothing written before is read but fingerprints and the counts of replaced texts.

Weights and lengths of all documents shift with every change of a term's document count, so they
are not stored: opening the index sums the deltas, takes each document's counts from its latest
version and computes lengths once, with today's weights. Search on it equals a fresh build.

A version counts once its `docs` part, written last, is complete; a rerun replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklore.operators.dedup import first_row
from stacklore.operators.joins import keep_keys, require_unique
from stacklore.operators.lexical import LexicalIndex, doc_term_counts, weighted_index
from stacklore.operators.refresh import DELETE, UPSERT, fingerprint
from stacklore.session import complete_parts, materialise

def _part(path: str, part: str) -> str:
    return f"{path.rstrip('/')}/{part}"


def _log(spark: SparkSession, path: str, part: str, before: int | None) -> DataFrame:
    """All rows of a part in complete versions, those below `before` if given."""
    done = versions(spark, path)
    done = [v for v in done if before is None or v < before]
    root = _part(path, part)
    return spark.read.option("basePath", root).parquet(*(f"{root}/version={v}" for v in done))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, in order."""
    return complete_parts(spark, _part(path, "docs"), "version")


def _current(spark: SparkSession, path: str, key: str, before: int | None = None) -> DataFrame:
    """The latest row of every key that is not deleted, with its version."""
    newest = first_row(_log(spark, path, "docs", before), key, [F.desc("version")])
    return newest.filter(F.col("_op") == UPSERT).drop("_op")


def _live_counts(spark: SparkSession, path: str, live: DataFrame, key: str, before: int | None = None) -> DataFrame:
    """(key, term, tf) of the given live documents; a document's counts are those of its version."""
    return _log(spark, path, "postings", before).join(live.select(key, "version"), [key, "version"]).drop("version")


def refresh_postings(docs: DataFrame, path: str, key: str, text_col: str, version: int, deletes: bool = True) -> DataFrame:
    """Write version `version` of the index at `path` and return its changes (key, _op).

    `docs` is a full snapshot with unique keys, or with `deletes=False` a set of new and
    changed rows. Versions are compared with those before them, so a retry changes nothing.
    """
    spark = docs.sparkSession
    require_unique(docs, key)
    known = any(v < version for v in versions(spark, path))
    new = docs.withColumn("_fp", fingerprint(docs.columns))
    changed, gone, replaced = new, None, None
    if known:
        old = materialise(_current(spark, path, key, version).select(key, "_fp", "version"), "index-keys")
        fresh = new.select(key, "_fp").join(old.select(key, "_fp"), [key, "_fp"], "left_anti")
        changed = keep_keys(new, fresh, key)
        touched = fresh.select(key)
        if deletes:
            gone = old.join(docs.select(key), key, "left_anti").select(key)
            touched = touched.unionByName(gone)
        replaced = old.join(touched, key, "left_semi")
    log = changed.withColumn("_op", F.lit(UPSERT))
    if gone is not None:
        log = log.unionByName(gone.withColumn("_op", F.lit(DELETE)), allowMissingColumns=True)
    log = materialise(log, "index-log")

    def target(part: str) -> str:
        return f"{_part(path, part)}/version={version}"

    texts = log.filter(F.col("_op") == UPSERT).select(key, F.col(text_col).alias("_text"))
    doc_term_counts(texts, key, "_text").write.mode("overwrite").parquet(target("postings"))
    moved = _moves(spark.read.parquet(target("postings")), texts, 1)
    if replaced is not None:
        moved = moved.unionByName(_moves(_live_counts(spark, path, replaced, key, version), replaced, -1))
    moved.groupBy("term").agg(F.sum("moved").alias("moved")).filter("moved <> 0").write.mode("overwrite").parquet(target("terms"))
    log.write.mode("overwrite").parquet(target("docs"))
    return spark.read.parquet(target("docs")).select(key, "_op")


def _moves(postings: DataFrame, docs: DataFrame, sign: int) -> DataFrame:
    """(term, moved): document counts of terms, and under NULL of all documents."""
    all_docs = docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("term"), "n")
    found_in = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return found_in.unionByName(all_docs).select("term", (F.col("n") * sign).alias("moved"))


def open_postings(spark: SparkSession, path: str, key: str) -> LexicalIndex:
    """The index as of its last complete version."""
    if not versions(spark, path):
        raise ValueError(f"no index at {path}")
    live = materialise(_current(spark, path, key).select(key, "version"), "index-live")
    found_in = materialise(
        _log(spark, path, "terms", None).groupBy("term").agg(F.sum("moved").alias("df")), "index-terms"
    )
    n_docs = found_in.filter("term is null").agg(F.sum("df")).first()[0] or 0
    found_in = found_in.filter("term is not null and df > 0")
    # Lengths of replaced texts are summed up too and left out by document: counts are not joined for that.
    ids = ("doc_id", "version")
    counts = _log(spark, path, "postings", None).withColumnRenamed(key, "doc_id")
    docs = _log(spark, path, "docs", None).drop("_fp", "_op").join(live, [key, "version"], "left_semi").drop("version")
    return weighted_index(counts, found_in, n_docs, docs, key, ids, live.withColumnRenamed(key, "doc_id"))


def compact_postings(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Write the live index as version 0 of a fresh folder."""
    live = materialise(_current(spark, path, key), "index-live")
    _live_counts(spark, path, live, key).write.parquet(f"{_part(target, 'postings')}/version=0")
    sums = _log(spark, path, "terms", None).groupBy("term").agg(F.sum("moved").alias("moved")).filter("moved <> 0")
    sums.write.parquet(f"{_part(target, 'terms')}/version=0")
    live.drop("version").withColumn("_op", F.lit(UPSERT)).write.parquet(f"{_part(target, 'docs')}/version=0")
