"""Text search without a model: TF-IDF cosine over an inverted index.

The index holds one row per (document, term), hash-partitioned by document. A posting's weight
is the term's count over the document's length; the term's idf, once for the document and once
for the question, is in the question's weights, so postings never meet the whole vocabulary.
A search broadcasts the terms of one question block, so scores are summed where the postings
lie, a few documents at a time with a running top-k, and only k rows per question and task are shuffled. A term in a third of all documents is
therefore as cheap as any other: postings are never grouped by term.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from stacklore.functions.text import tokens
from stacklore.operators.blocks import question_blocks, split_large
from stacklore.operators.joins import BROADCAST_ROWS, require_unique
from stacklore.operators.ranking import top_k
from stacklore.operators.topk_kernel import SCORE_DIGITS, TermWeights, best_documents
from stacklore.session import materialise

# Rows (question, term, weight) broadcast per search pass: about 10 MB.
BLOCK_TERMS = 100_000
# Texts whose tokens are counted at a time.
TEXTS_AT_ONCE = 256
_COUNTS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))


@dataclass(frozen=True)
class LexicalIndex:
    """postings(doc_id, term, weight), terms(term, idf) and the documents with attributes.

    An index just built also has what its postings are made of: `counts` (*ids, term, tf) and
    `lengths` (*ids, length, lead); the first of `ids` is the document.
    """

    postings: DataFrame
    terms: DataFrame
    docs: DataFrame
    id_col: str
    counts: DataFrame | None = None
    lengths: DataFrame | None = None


def term_counts(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, term, tf). All tokens of a text meet in one task, so the map side combines fully."""
    found = df.select(F.col(key), F.explode(tokens(F.col(text_col))).alias("term"))
    return found.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _counted_tokens(texts: pa.Array) -> pa.Array:
    """Per text, given as its tokens, its distinct tokens with their counts."""
    parts = [_counted_part(texts.slice(at, TEXTS_AT_ONCE)) for at in range(0, len(texts), TEXTS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], to_arrow_type(_COUNTS))


def _counted_part(texts: pa.Array) -> pa.Array:
    sizes = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    found = texts.flatten().dictionary_encode()
    n = max(1, len(found.dictionary))
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds, tf = np.unique(np.repeat(np.arange(len(texts)), sizes) * n + codes, return_counts=True)
    ends = np.searchsorted(kinds, np.arange(len(texts) + 1) * n).astype(np.int32)
    terms = found.dictionary.take(pa.array(kinds % n))
    counts = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int64())], names=["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends), counts).cast(to_arrow_type(_COUNTS))


def doc_term_counts(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """`term_counts` of many long texts, each in one row with a key of its own: a text is counted where it is read.

    Nothing is shuffled, and no table of all (key, term) of a task is held.
    """
    counted = F.arrow_udf(_counted_tokens, _COUNTS)(tokens(F.col(text_col)))
    return df.select(F.col(key), counted.alias("_counts")).select(key, F.inline("_counts"))


def build_lexical_index(docs: DataFrame, id_col: str, text_col: str) -> LexicalIndex:
    """Index `docs` by `text_col`; an `id_col` that is not unique is refused.

    Token counts, the vocabulary and the documents' lengths are written once. The weights stay
    lazy, partitioned by document; save the index to search it repeatedly.
    """
    require_unique(docs, id_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    counts = materialise(doc_term_counts(keyed, "doc_id", "_text"), "term-counts")
    found_in = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return weighted_index(counts, found_in, docs.count(), docs, id_col)


def weighted_index(
    counts: DataFrame, found_in: DataFrame, n_docs: int, docs: DataFrame, id_col: str,
    ids: Sequence[str] = ("doc_id",), live: DataFrame | None = None,
) -> LexicalIndex:
    """The index of (*ids, term, tf) and (term, df), of the documents in `live` (*ids) if given.

    `counts` is read several times.
    """
    idf = F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))
    # A term of every document has no weight.
    terms = materialise(found_in.select("term", idf.alias("idf")).filter("idf > 0"), "terms")
    lengths = doc_lengths(counts, terms, ids)
    if live is not None:
        lengths = lengths.join(live, list(ids), "left_semi")
    lengths = materialise(lengths, "lengths")
    return LexicalIndex(unit_postings(counts, lengths, ids), terms, docs, id_col, counts, lengths)


def unit_postings(counts: DataFrame, lengths: DataFrame, ids: Sequence[str], *more: str) -> DataFrame:
    """(*more, doc_id, term, weight) of (*ids, term, tf) and (*ids, length, *more); leaves rows partitioned by `ids`."""
    met = counts.join(lengths.select(*ids, "length", *more).hint("shuffle_hash"), list(ids))
    return met.select(*more, "doc_id", "term", (F.col("tf") / F.col("length")).alias("weight"))


def _postings_of(index: LexicalIndex, terms: DataFrame) -> DataFrame:
    """The postings of `terms` (term); of others nothing is shuffled to meet the documents' lengths."""
    if index.counts is None or index.lengths is None:
        return index.postings  # stored by document: nothing is shuffled at all
    ids = [c for c in index.lengths.columns if c not in ("length", "lead")]
    return unit_postings(index.counts.join(terms, "term", "left_semi"), index.lengths, ids)


def doc_lengths(counts: DataFrame, terms: DataFrame, ids: Sequence[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """(*ids, length, lead) of documents with weighted terms: the root of their summed squares of tf * idf, and a
    number that documents with the same heaviest term share.

    Of (*ids, term, tf) and (term, idf). The at most `limit` most frequent terms are broadcast; most postings
    are theirs, and a document's are summed up where they lie. Postings of the other terms alone are shuffled.
    """
    kind = F.ceil(F.col("idf") * 4)  # of a small idf: frequent
    sizes = terms.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).orderBy("kind").collect()
    last, filled = None, 0
    for size in sizes:
        filled += size.n
        if filled <= limit:
            last = size.kind
    weight = F.col("tf") * F.col("idf")
    # The weight in thousandths above 32 bits of the term: the largest is an aggregate of plain numbers.
    lead = F.shiftleft(F.least(F.round(weight * 1000), F.lit(2.0**30)).cast("bigint"), 32) + F.pmod(F.xxhash64("term"), F.lit(2**32))

    def parts(met: DataFrame) -> DataFrame:
        return met.select(*ids, (weight * weight).alias("_square"), lead.alias("_lead"))

    if last is None:
        found = [parts(counts.join(terms, "term"))]
    else:
        frequent = F.broadcast(terms.filter(kind <= last))
        found = [parts(counts.join(frequent, "term"))]
        if filled > limit:
            found.append(parts(counts.join(frequent, "term", "left_anti").join(terms.filter(kind > last), "term")))
    sums = reduce(DataFrame.unionByName, found).groupBy(*ids)
    return sums.agg(F.sqrt(F.sum("_square")).alias("length"), F.max("_lead").bitwiseAND(2**32 - 1).alias("lead"))


def question_terms(questions: DataFrame, terms: DataFrame, qid: str, text_col: str) -> DataFrame:
    """(qid, term, weight) of the questions, in the index's vocabulary.

    The weights of a question have unit length, times the idf that postings lack.
    """
    keyed = questions.select(F.col(qid).alias("qid"), F.col(text_col).alias("_text"))
    counts = term_counts(keyed, "qid", "_text")
    weighted = counts.join(terms, "term").select("qid", "term", "idf", (F.col("tf") * F.col("idf")).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("qid")))
    return weighted.select("qid", "term", (F.col("_w") / length * F.col("idf")).alias("weight"))


def numbered(asked: DataFrame, weight: str = "weight") -> tuple[DataFrame, TermWeights]:
    """(term, no) and the questions' weights by that number, of one block (qid, term, weight), which is broadcast."""
    rows = asked.select("term", "qid", F.col(weight).alias("w")).toArrow().combine_chunks()
    terms, ids = rows["term"].combine_chunks().dictionary_encode(), rows["qid"].combine_chunks().dictionary_encode("encode")
    numbers, questions = (e.indices.to_numpy(zero_copy_only=False) for e in (terms, ids))
    order = np.argsort(numbers, kind="stable")
    start = np.searchsorted(numbers[order], np.arange(len(terms.dictionary) + 1))
    weights = TermWeights(ids.dictionary, start, questions[order], rows["w"].to_numpy()[order])
    table = pa.table({"term": terms.dictionary, "no": pa.array(range(len(terms.dictionary)), pa.int32())})
    return F.broadcast(asked.sparkSession.createDataFrame(table)), weights


def best_of_postings(postings: DataFrame, weights: TermWeights, qid: T.DataType, k: int, *open_to: Column, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(qid, doc_id, score): per task the k best documents of every question, of (*ids, no, weight).

    A document's postings are put together first; no row per question and document is made.
    """
    lists = postings.groupBy(*ids).agg(F.collect_list(F.struct("no", "weight")).alias("_p"), *open_to)
    rows = lists.select("doc_id", F.col("_p.no"), F.col("_p.weight"), *(c for c in lists.columns if c not in (*ids, "_p")))
    kinds = T.StructType([T.StructField("qid", qid), postings.schema["doc_id"], T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(kinds)
    return rows.mapInArrow(lambda batches: best_documents(batches, weights, k, schema), kinds)


def search_lexical(
    questions: DataFrame,
    index: LexicalIndex,
    k: int = 5,
    where: Column | None = None,
    qid: str = "qid",
    text_col: str = "question",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(qid, doc_id, score, rank): the k documents closest to every question by cosine.

    `where` filters documents by their attributes before scoring. Equal scores are ordered
    by document id. Documents sharing no weighted term with a question are no hits. A question
    of more than `block_terms` terms is scored term block by term block, and its sums meet by
    (question, document) in one more shuffle.
    """
    asked = materialise(question_terms(questions, index.terms, qid, text_col), "question-terms")

    def near(terms: DataFrame) -> DataFrame:
        found = _postings_of(index, terms)
        if where is not None:
            allowed = index.docs.filter(where).select(F.col(index.id_col).alias("doc_id"))
            found = found.join(allowed, "doc_id", "left_semi")
        return found

    def best(block: DataFrame) -> DataFrame:
        terms, weights = numbered(block)
        postings = near(terms.select("term")).join(terms, "term")
        return best_of_postings(postings, weights, asked.schema["qid"].dataType, k)

    def sums(block: DataFrame) -> DataFrame:
        terms = F.broadcast(block.select("qid", "term", F.col("weight").alias("_qw")))
        found = near(F.broadcast(block.select("term").distinct())).join(terms, "term").groupBy("qid", "doc_id")
        return found.agg(F.sum(F.col("weight") * F.col("_qw")).alias("_sum"))

    usual, parts = split_large(asked, "qid", "term", block_terms)
    scored = [best(block) for block in question_blocks(usual, "qid", block_terms)]
    if parts:
        # Dealt anew: the parts' partitions, each fitted at run time, need not be the same.
        met = reduce(DataFrame.unionByName, [sums(part) for part in parts]).repartition("qid", "doc_id")
        met = met.groupBy("qid", "doc_id").agg(F.round(F.sum("_sum"), SCORE_DIGITS).alias("score"))
        scored.append(met)
    if not scored:
        q_type = asked.schema["qid"].dataType.simpleString()
        d_type = index.postings.schema["doc_id"].dataType.simpleString()
        empty = questions.sparkSession.createDataFrame([], f"qid {q_type}, doc_id {d_type}, score double")
        return empty.withColumn("rank", F.lit(1))
    hits = [top_k(s, ["qid"], [F.desc("score"), F.asc("doc_id")], k) for s in scored]
    return reduce(DataFrame.unionByName, hits)


def save_lexical_index(index: LexicalIndex, namespace: str, name: str, buckets: int) -> None:
    """Store an index as `<name>_search` and companions, bucketed by document.

    Buckets keep the sums shuffle-free when the index is read back; sorting by term lets
    the scan skip row groups without a question's terms.
    """
    def store(df: DataFrame, suffix: str, keys: list[str], sort: list[str]) -> None:
        (
            df.repartition(buckets, *keys)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, *keys)
            .sortBy(*sort)
            .saveAsTable(f"`{namespace}`.`{name}{suffix}`")
        )

    store(index.postings, "_search", ["doc_id"], ["term"])
    store(index.terms, "_search_terms", ["term"], ["term"])
    store(index.docs, "_search_docs", [index.id_col], [index.id_col])


def open_lexical_index(spark: SparkSession, namespace: str, name: str, id_col: str) -> LexicalIndex:
    def table(suffix: str) -> DataFrame:
        return spark.table(f"`{namespace}`.`{name}{suffix}`")

    return LexicalIndex(table("_search"), table("_search_terms"), table("_search_docs"), id_col)
