"""Text search that leaves out blocks of documents which cannot hold a hit.

Documents are sorted by their heaviest term and cut into blocks, so that documents about one
thing share blocks. Per block and term the largest weight is kept. A question's bound on a block
is the sum of its terms' weights times those maxima: no document of the block scores more.

A search scores each question's FIRST_BLOCKS blocks of largest bound. The k-th best score among
them is the question's threshold; of the other blocks only those whose bound reaches it are read
for that question, and nothing is summed for the documents of the rest. Hits are those of the
exhaustive search. There is no third pass: every pass scans the postings.

Per question and block there is one bound, some 2**BLOCK_BITS times fewer than documents. The
first pass reads few blocks, by broadcast. The second reads the postings of the questions' terms,
dealt by block to the bits of the questions that a block is open to, so that the sums of a
document's terms are made in the task that has its block and no (question, posting) pair moves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklore.operators.blocks import question_blocks
from stacklore.operators.joins import counted
from stacklore.operators.lexical import (
    BLOCK_TERMS, LexicalIndex, best_of_postings, doc_lengths, numbered, question_terms, unit_postings,
)
from stacklore.operators.ranking import top_k
from stacklore.operators.topk_kernel import SCORE_DIGITS
from stacklore.session import materialise

BLOCK_BITS = 6  # 64 documents a block
FIRST_BLOCKS = 4
# Sums in another order differ in the last digits; bounds are widened by more than that.
SLACK = 2.0 * 10**-SCORE_DIGITS


@dataclass(frozen=True)
class BlockIndex:
    """postings(block, doc_id, term, weight), maxima(block, term, most), terms and documents.

    `maxima` is a view of the postings; a search takes the maxima of its questions' terms only.
    """

    postings: DataFrame
    maxima: DataFrame
    terms: DataFrame
    docs: DataFrame
    id_col: str


def block_index(index: LexicalIndex, block_bits: int = BLOCK_BITS) -> BlockIndex:
    """Cut an index into blocks; postings are written, to be searched repeatedly."""
    spark = index.docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts, lengths = index.counts, index.lengths
    if counts is None or lengths is None:  # a stored index: weights for counts, lengths of one
        counts = index.postings.withColumnRenamed("weight", "tf")
        lengths = materialise(doc_lengths(counts, index.terms, ["doc_id"]), "lengths")
    ids = [c for c in lengths.columns if c not in ("length", "lead")]
    order = ["lead", "doc_id"]
    sorted_docs = lengths.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Numbers run on within a partition, so a block never spans two.
    block = F.shiftright(F.monotonically_increasing_id(), block_bits)
    blocks = materialise(sorted_docs.select(*ids, "length", block.alias("block")), "blocks")
    postings = materialise(unit_postings(counts, blocks, ids, "block"), "block-postings")
    return BlockIndex(postings, _maxima(postings), index.terms, index.docs, index.id_col)


def _maxima(postings: DataFrame) -> DataFrame:
    """(block, term, most), partitioned by block."""
    return postings.repartition("block").groupBy("block", "term").agg(F.max("weight").alias("most"))


def _scores(postings: DataFrame, asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """(qid, doc_id, score) of the documents of the given (qid, block) pairs."""
    wanted = counted(pairs.select("qid", "block").join(asked, "qid").select("qid", "block", "term", "qw"), "block-terms")
    return postings.join(wanted, ["block", "term"]).groupBy("qid", "doc_id").agg(
        F.round(F.sum(F.col("weight") * F.col("qw")), SCORE_DIGITS).alias("score")
    )


def search_blocks(
    questions: DataFrame,
    index: BlockIndex,
    k: int = 5,
    where: Column | None = None,
    qid: str = "qid",
    text_col: str = "question",
    scored: list[DataFrame] | None = None,
) -> DataFrame:
    """(qid, doc_id, score, rank): the k documents closest to every question by cosine.

    `where` filters documents by their attributes before scoring. Equal scores are ordered by
    document id; documents sharing no weighted term with a question are no hits. Both passes'
    (qid, block) pairs are added to `scored`, if given.
    """
    postings = index.postings
    if where is not None:
        allowed = index.docs.filter(where).select(F.col(index.id_col).alias("doc_id"))
        postings = postings.join(allowed, "doc_id", "left_semi")
    asked = materialise(
        question_terms(questions, index.terms, qid, text_col).withColumnRenamed("weight", "qw"), "question-terms"
    )
    largest = asked.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = question_blocks(asked, "qid", max(BLOCK_TERMS, largest)) or [asked]
    return reduce(DataFrame.unionByName, [_search(block, postings, k, scored) for block in blocks])


def _search(asked: DataFrame, postings: DataFrame, k: int, scored: list[DataFrame] | None) -> DataFrame:
    """The hits of one block of questions; its terms are few enough to be broadcast."""
    order = [F.desc("score"), F.asc("doc_id")]
    terms = F.broadcast(asked.select("term").distinct())
    near = postings.join(terms, "term", "left_semi")
    # A block's maxima are in one task, so a question's bound on it is complete there.
    bounds = _maxima(near).join(F.broadcast(asked), "term").groupBy("block", "qid").agg(
        (F.sum(F.col("most") * F.col("qw")) + SLACK).alias("bound")
    ).select("qid", "block", "bound")
    by_bound = Window.partitionBy("qid").orderBy(F.desc("bound"), "block")
    open_pairs = materialise(bounds.withColumn("place", F.row_number().over(by_bound)), "block-bounds")
    first = open_pairs.filter(F.col("place") <= FIRST_BLOCKS)
    best = materialise(top_k(_scores(near, asked, first), ["qid"], order, k).drop("rank"), "block-best")
    least = best.groupBy("qid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    others = open_pairs.filter(F.col("place") > FIRST_BLOCKS).join(least.select("qid", "least"), "qid", "left")
    reach = others.filter(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
    if scored is not None:
        scored += [first.select("qid", "block"), reach.select("qid", "block")]
    return top_k(_block_best(near, asked, reach, k).unionByName(best), ["qid"], order, k)


def _block_best(postings: DataFrame, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The best of `_scores` for many pairs: a block meets the bits of its questions, in the task that has its postings."""
    terms, weights = numbered(asked, "qw")
    # At most as many questions as a block of them has terms.
    table = pa.table({"qid": weights.ids, "_no": pa.array(range(len(weights.ids)), pa.int32())})
    numbers = asked.sparkSession.createDataFrame(table, schema=f"qid {asked.schema['qid'].dataType.simpleString()}, _no int")
    word, bit = F.shiftright("_no", 6), F.col("_no").bitwiseAND(63)
    words = max(0, len(weights.ids) - 1) >> 6
    numbers = F.broadcast(numbers.select("qid", word.alias("_word"), bit.alias("_bit")))
    bits = pairs.select("qid", "block").join(numbers, "qid").groupBy("block", "_word").agg(
        F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits")
    )
    by_word = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(words)), lambda w: F.coalesce(F.try_element_at("_map", w), F.lit(0)))
    wanted = bits.groupBy("block").agg(by_word.alias("_map")).select("block", dense.alias("_open"))
    met = postings.join(wanted.hint("shuffle_hash"), "block").join(terms, "term")
    return best_of_postings(met, weights, asked.schema["qid"].dataType, k, F.first("_open").alias("_open"), ids=("block", "doc_id"))
