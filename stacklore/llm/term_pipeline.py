"""Ranked search by pipelined term partitioning.

Every term of the items has one owner; owners hold contiguous ranges of terms from the rarest
to the most frequent, with about equally many postings each. A bundle of items visits the
owners one after the other. It carries, per block of documents, a sparse accumulator of
(item, document, sum of integer contributions); at each owner the bundles are cogrouped with
that owner's postings of the block, contributions are added, and the bundle goes on. After the
last owner the best k per item and block are selected, then the best k of all.

What a bundle carries is cut by exact bounds only. An item's threshold is the k-th largest sum
of any one block so far: at least k documents reach it, as contributions are never negative. A
document goes on only if its sum and the largest contributions of all terms still to come reach
the threshold; one not met before is taken up only if those of this and the coming owners do.
Ties at the threshold go on.

Texts are read once a bundle, in place: only the item terms' counts leave the task, one row per
document with its length. A block is at most BLOCK_DOCS documents or, but for its last document,
BLOCK_POSTINGS postings of one task. Bundles are the stated query set in blocks: at most
BUNDLE_BYTES of item text (a longer text is a bundle of its own) and their terms' statistics
reach the tasks with the code. The driver holds one bundle, its terms' document counts and one
threshold per item.

Contribution of a term: w * ((1000000000 * tf) div (1000 * tf + 8 * m)), with
m = 100 - 90 + ((90 * n * N) div L) and w = floor(1000 * ln((2 N + 2) / (2 df + 1))).

Defined cases: null and empty texts have no terms and are not counted in N; items without a
known term give no rows; items equal in id and text count once, items that share an id with
other texts are ranked each on its own; rows repeated in the documents are documents of their
own, as are null ids, which rank before others of equal score; empty tables give no rows;
other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stacklore.session import materialise

OWNERS = 4
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
BUNDLE_BYTES = 4 << 20
# Fixed values of the score.
FREE, SLOPE, SATURATION, SCALE = 100 - 90, 90, 8, 1_000_000_000

POSTINGS = "block long, slot int, doc_id {kind}, n long, terms array<int>, counts array<int>"
CARRIED = "block long, item int, slot array<int>, total array<long>"

# Bytes of terms: digits, letters and all of a character beyond ASCII; A-Z become a-z, others divide.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass
class Bundle:
    """Items of one pass with the statistics of their terms, terms numbered from rare to frequent."""

    items: list[np.ndarray]
    weight: np.ndarray
    most: np.ndarray
    bounds: list[int]
    documents: int
    words: int
    rank: np.ndarray  # vocabulary number -> term number

    def gains(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = FREE + (SLOPE * n * self.documents) // self.words
        return self.weight[term] * ((SCALE * tf) // (1000 * tf + SATURATION * m))

    def owned(self, item: int, owner: int) -> np.ndarray:
        terms = self.items[item]
        return terms[(terms >= self.bounds[owner]) & (terms < self.bounds[owner + 1])]

    def still(self, owner: int) -> np.ndarray:
        """Per item, the most that terms of this owner and those after it can add."""
        return np.array([self.most[t[t >= self.bounds[owner]]].sum() for t in self.items], np.int64)


def bundles(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Item texts in blocks of bounded size; the driver holds one block."""
    rows = items.select(items[item_id].alias("item_id"), items[text].alias("text")).distinct()
    size, held = 0, []
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        length = len(row["text"] or "")
        if held and size + length > BUNDLE_BYTES:
            yield held
            size, held = 0, []
        held.append((row["item_id"], row["text"]))
        size += length
    if held:
        yield held


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per document with a term: its block and slot, length, and the known terms' counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, slot, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                if slot == BLOCK_DOCS or held >= BLOCK_POSTINGS:
                    block, slot, held = block + 1, 0, 0
                known = [(vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary]
                rows.append((block, slot, doc_id, len(words), [t for t, _ in known], [c for _, c in known]))
                slot, held = slot + 1, held + len(known)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            ints = pa.list_(pa.int32())
            kinds = [pa.int64(), pa.int32(), batch.schema.field(0).type, pa.int64(), ints, ints]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["block", "slot", "doc_id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(run, POSTINGS.format(kind=kind))


def with_statistics(texts: list[list[bytes]], vocabulary: dict[bytes, int], postings: DataFrame) -> Bundle | None:
    """Document counts, weights and largest contributions of the terms; None without any document."""
    total = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    documents, words = total[0], total[1] or 0
    if not documents:
        return None
    pairs = postings.select("n", F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    tf, n = F.col("p.counts").cast("long"), F.col("n")
    m = F.lit(FREE) + F.expr(f"({SLOPE} * n * {documents}) div {words}")
    shares = pairs.select(F.col("p.terms").alias("term"), tf.alias("tf"), m.alias("m"))
    share = F.expr(f"({SCALE} * tf) div (1000 * tf + {SATURATION} * m)")
    counted = shares.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(share).alias("share")).collect()
    df, share_of = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for row in counted:
        df[row["term"]], share_of[row["term"]] = row["df"], row["share"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    # Owners: about equal shares of the postings, the rarest terms first.
    order = np.argsort(df, kind="stable")
    place = np.cumsum(df[order])
    cuts = np.searchsorted(place, [place[-1] * i / OWNERS for i in range(1, OWNERS)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    items = [np.sort(rank[[vocabulary[w] for w in set(t)]]) if t else np.empty(0, np.int64) for t in texts]
    items = [t[df[order][t] > 0] for t in items]
    bounds = [0, *map(int, cuts), len(order)]
    return Bundle(items, weight[order], (weight * share_of)[order], bounds, documents, words, rank)


def _owned_postings(postings: DataFrame, bundle: Bundle, owner: int) -> DataFrame:
    """(block, slot, n, term, tf) of one owner's terms."""
    rank, low, high = bundle.rank, bundle.bounds[owner], bundle.bounds[owner + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            each = np.diff(np.asarray(lists.offsets))
            term = rank[np.asarray(lists.flatten(), np.int64)]
            keep = (term >= low) & (term < high)
            row = np.repeat(np.arange(len(each)), each)[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                    batch.column(2).take(pa.array(row)), pa.array(term[keep].astype(np.int32)),
                    pa.array(np.asarray(batch.column(4).flatten(), np.int32)[keep]),
                ],
                names=["block", "slot", "n", "term", "tf"],
            )

    return postings.select("block", "slot", "n", "terms", "counts").mapInArrow(
        run, "block long, slot int, n long, term int, tf int"
    )


def _rows(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def visit(carried: DataFrame, postings: DataFrame, bundle: Bundle, owner: int, floor: np.ndarray, k: int) -> DataFrame:
    """The bundle's accumulators after one owner has added its terms' contributions."""
    coming, after = bundle.still(owner), bundle.still(owner + 1)

    def add(bundles_here: pa.Table, owned: pa.Table) -> pa.Table:
        block = (bundles_here if bundles_here.num_rows else owned).column("block")[0].as_py()
        slots, term = _rows(owned, "slot"), _rows(owned, "term").astype(np.int64)
        gain = bundle.gains(term, _rows(owned, "tf").astype(np.int64), _rows(owned, "n"))
        order = np.argsort(term, kind="stable")
        slots, gain, term = slots[order], gain[order], term[order]
        names, first, many = np.unique(term, return_index=True, return_counts=True)
        place = dict(zip(names.tolist(), zip(first.tolist(), (first + many).tolist(), strict=True), strict=True))
        brought: dict[int, tuple] = {}
        for i, s, t in zip(*[bundles_here.column(c).to_pylist() for c in ("item", "slot", "total")], strict=True):
            brought[i] = (np.array(s, np.int64), np.array(t, np.int64))
        totals, met = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, bool)
        out: list[tuple] = []
        for item in range(len(bundle.items)):
            here = [place[t] for t in bundle.owned(item, owner).tolist() if t in place]
            if item not in brought and not here:
                continue
            totals[:] = 0
            met[:] = False
            if item in brought:
                at, total = brought[item]
                totals[at], met[at] = total, True
            taken_up = coming[item] >= floor[item]
            for a, b in here:
                totals[slots[a:b]] += gain[a:b]
                if taken_up:
                    met[slots[a:b]] = True
            at = np.flatnonzero(met)
            total = totals[at]
            least = floor[item]
            if len(total) >= k:
                least = max(least, np.partition(total, len(total) - k)[len(total) - k])
            keep = total + after[item] >= least
            if keep.any():
                out.append((block, item, at[keep].astype(np.int32), total[keep]))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "item", "slot", "total"]
        )

    own = _owned_postings(postings, bundle, owner)
    return carried.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(add, CARRIED)


def thresholds(carried: DataFrame, items: int, k: int) -> np.ndarray:
    """Per item, the largest k-th best sum of any block, 0 where no block holds k."""
    best = F.sort_array("total", asc=False)
    found = carried.filter(F.size("total") >= k).groupBy("item").agg(F.max(F.element_at(best, k)).alias("floor"))
    floor = np.zeros(items, np.int64)
    for row in found.collect():
        floor[row["item"]] = row["floor"]
    return floor


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    chosen = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    kinds = items.select(items[item_id].alias("item_id")).schema["item_id"].dataType.simpleString()
    kind = chosen.schema["doc_id"].dataType.simpleString()
    results = []
    for held in bundles(items, item_id, item_text):
        texts = [terms_of(t) for _, t in held]
        vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        if not vocabulary:
            continue
        postings = materialise(count_terms(chosen, vocabulary), "search-postings")
        bundle = with_statistics(texts, vocabulary, postings)
        if bundle is None:
            return spark.createDataFrame([], f"item_id {kinds}, rank int, doc_id {kind}, score long")
        carried = spark.createDataFrame([], CARRIED)
        floor = np.zeros(len(held), np.int64)
        for owner in range(OWNERS):
            carried = materialise(visit(carried, postings, bundle, owner, floor, k), "search-bundle")
            floor = np.maximum(floor, thresholds(carried, len(held), k))
        names = spark.createDataFrame([(i, row[0]) for i, row in enumerate(held)], f"item int, item_id {kinds}")
        reached = carried.select("block", "item", F.explode(F.arrays_zip("slot", "total")).alias("p")).select(
            "block", "item", F.col("p.slot").alias("slot"), F.col("p.total").alias("score")
        ).filter("score > 0")
        ids = postings.select("block", "slot", "doc_id")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "block", "slot")
        best = reached.join(ids, ["block", "slot"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        results.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kinds}, rank int, doc_id {kind}, score long")
    found = results[0]
    for more in results[1:]:
        found = found.unionAll(more)
    return found
