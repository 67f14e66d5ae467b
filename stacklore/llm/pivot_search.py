"""Exact top-k by inner product over a pivot-distance index.

Vectors become whole numbers floor(SCALE * x). One more coordinate, the root of M - |x|^2 with
M the largest squared norm (0 for queries), makes squared Euclidean distance a falling function
of the inner product, so distance bounds are score bounds. Each vector is keyed by its nearest
pivot and its distance to it; the index is range-sorted by that key and cut into parts of
PART_ROWS rows, each a few annuli. By the triangle inequality an annulus [near, far] of a pivot
at distance r from the query holds nothing closer than max(r - far, near - r, 0).

A query visits parts in the order of their bounds, in growing rounds, and stops when no part's
bound reaches its k-th score. A round is one shuffle: index rows and the requests for a part
meet in one task, index rows first (PART_ROWS at most), requests streaming past them, and each
request returns k rows. Pivots are PIVOTS rows by smallest hash of the id, a bounded sample;
every row is indexed and results are exact. The directory of annuli is broadcast: at most
MAX_ANNULI rows.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part;
shorter vectors count as filled up with zeros; rows repeated with one id are separate candidates
of other ids' queries, and one query, by their smallest vector; no row with a query's id is its
candidate; a null id is no query and comes last among ties; with fewer than k candidates all are returned; an empty
table gives no rows; other columns do not matter. Scores are exact while they stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklore.llm.common import with_row_numbers
from stacklore.session import materialise

SCALE = 1024
PIVOTS = 32
PART_ROWS = 8192
ANNULI_PER_PART = 8
MAX_ANNULI = 1 << 16
GROWTH = 8
BATCH = 256  # requests per matrix product
EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist() if len(set(column.value_lengths().to_pylist())) > 1 else None
    if rows is not None:
        return np.array([r + [0] * (width - len(r)) for r in rows], np.float64).reshape(-1, width)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.pad(flat, ((0, 0), (0, width - flat.shape[1])))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0.0))


def _to_pivots(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares + (lift[:, None] - pivot_lift[None, :]) ** 2, 0.0))


class Directory:
    """Annuli of all parts, and the pivots: what a query needs to bound parts."""

    def __init__(self, pivots: np.ndarray, top: float, width: int, annuli: list[tuple]):
        self.pivots, self.top, self.width = pivots, top, width
        self.pivot_lift = _lifted(pivots, top)
        self.pivot = np.array([a[1] for a in annuli], np.int64)
        self.near = np.array([a[2] for a in annuli])
        self.far = np.array([a[3] for a in annuli])
        parts = np.array([a[0] for a in annuli], np.int64)
        self.order = np.argsort(parts, kind="stable")
        self.parts, self.starts = np.unique(parts[self.order], return_index=True)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score each part can hold, (queries, parts)."""
        r = _to_pivots(queries, np.zeros(len(queries)), self.pivots, self.pivot_lift)[:, self.pivot]
        # Distances carry rounding errors; the slack keeps bounds on the safe side.
        slack = 1e-9 * (1 + r + self.far) + 1e-6
        gap = np.maximum(np.maximum(r - self.far, self.near - r) - slack, 0.0)
        norm = (queries * queries).sum(1)
        upper = (norm[:, None] + self.top - gap**2) / 2 + 1e-6 * (1 + norm[:, None] + self.top)
        return np.maximum.reduceat(upper[:, self.order], self.starts, axis=1)


def _indexed(vectors: DataFrame, directory: Directory) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), directory.width)
            d = _to_pivots(x, _lifted(x, directory.top), directory.pivots, directory.pivot_lift)
            nearest = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest, pa.int64()), pa.array(d[np.arange(len(d)), nearest])],
                names=["vec_id", "v", "pivot", "distance"],
            )

    return vectors.mapInArrow(run, "vec_id long, v array<bigint>, pivot long, distance double")


def _requests(queries: DataFrame, directory: Directory, skip: int, take: int) -> DataFrame:
    """Parts number skip..skip+take in each query's order whose bound reaches its k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                upper = directory.bounds(_matrix(part.column(1), directory.width))
                floor = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                order = np.argsort(-upper, axis=1, kind="stable")[:, skip:skip + take]
                wanted = np.take_along_axis(upper, order, 1) >= np.where(np.isnan(floor), -np.inf, floor)[:, None]
                row, column = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     pa.array(directory.parts[order[row, column]], pa.int64())],
                    names=["query_id", "v", "part"],
                )

    return queries.mapInArrow(run, "query_id long, v array<bigint>, part long")


def _answers(met: DataFrame, k: int, width: int) -> DataFrame:
    """k best of a part for each request; rows come sorted by part, index rows first."""

    def answer(ids: np.ndarray, x: np.ndarray, query_ids: list, q: np.ndarray) -> pa.RecordBatch:
        exact = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, width) < EXACT
        scores = q @ x.T if exact else (q.astype(np.int64) @ x.astype(np.int64).T)
        rows, columns = [], []
        for i, query in enumerate(query_ids):
            s = scores[i]
            own = ids == query
            free = np.nonzero(~own)[0]
            if len(free) > k:
                worst = -np.partition(-s[free], k - 1)[k - 1]
                free = free[s[free] >= worst]
            best = free[np.lexsort((ids[free], -s[free]))][:k]
            rows.append(np.full(len(best), i))
            columns.append(best)
        row, column = np.concatenate(rows), np.concatenate(columns)
        found = ids[column]
        return pa.RecordBatch.from_arrays(
            [pa.array([query_ids[i] for i in row], pa.int64()),
             pa.array(found, pa.int64(), mask=found == np.iinfo(np.int64).max),
             pa.array(np.asarray(scores[row, column]).astype(np.int64))],
            names=["query_id", "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, blocks, matrix = None, [], [], None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            asked = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.nonzero((np.diff(parts) != 0) | (np.diff(asked.astype(np.int8)) != 0))[0] + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start == stop:
                    continue
                piece = batch.slice(start, stop - start)
                if parts[start] != part:
                    part, ids, blocks, matrix = parts[start], [], [], None
                if not asked[start]:
                    numbers = piece.column(2).fill_null(np.iinfo(np.int64).max)
                    ids.append(numbers.to_numpy())
                    blocks.append(_matrix(piece.column(3), width))
                    continue
                if matrix is None:
                    matrix = (np.concatenate(ids), np.concatenate(blocks)) if ids else (np.empty(0, np.int64), np.empty((0, width)))
                for at in range(0, piece.num_rows, BATCH):
                    block = piece.slice(at, BATCH)
                    yield answer(*matrix, block.column(2).to_pylist(), _matrix(block.column(3), width))

    return met.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `vectors` that `is_query` marks."""
    schema = "query_id long, rank int, vec_id long, score long"
    chosen = vectors.filter(usable(vectors[vector])).select(
        vectors[id_column].cast("long").alias("vec_id"), scaled(vectors[vector]).alias("v"),
        (F.coalesce(is_query, F.lit(False)) & vectors[id_column].isNotNull()).alias("asks"),
    )
    whole = materialise(chosen, "pivot-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = whole.agg(F.max(norm).alias("top"), F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return vectors.sparkSession.createDataFrame([], schema)
    width, top = max(1, facts["width"]), float(facts["top"])
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("v").collect()
    pivots = np.unique(np.array([r["v"] + [0] * (width - len(r["v"])) for r in sample], np.float64), axis=0)
    keyed = _indexed(whole.select("vec_id", "v"), Directory(pivots, top, width, [(0, 0, 0.0, 0.0)]))
    numbered, n = with_row_numbers(keyed, ["pivot", "distance", "vec_id"], "pivot-index", "_row")
    part_rows = max(PART_ROWS, -(-n * ANNULI_PER_PART // MAX_ANNULI))
    ring_rows = max(1, part_rows // ANNULI_PER_PART)
    index = materialise(
        numbered.select("vec_id", "v", "pivot", "distance", F.floor(F.col("_row") / part_rows).cast("long").alias("part"),
                        F.floor(F.col("_row") / ring_rows).cast("long").alias("ring")),
        "pivot-parts",
    )
    annuli = index.groupBy("part", "ring", "pivot").agg(F.min("distance").alias("near"), F.max("distance").alias("far"))
    directory = Directory(pivots, top, width, [(r["part"], r["pivot"], r["near"], r["far"]) for r in annuli.collect()])
    queries = whole.filter("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    open_queries = queries.withColumn("floor", F.lit(None).cast("long"))
    best, skip, take = None, 0, 1
    while skip < len(directory.parts):
        requests = materialise(_requests(open_queries, directory, skip, take), "pivot-requests")
        if requests.isEmpty():
            break
        rows = index.select("part", F.lit(False).alias("asked"), F.col("vec_id").alias("id"), "v").unionByName(
            requests.select("part", F.lit(True).alias("asked"), F.col("query_id").alias("id"), "v")
        )
        wanted = requests.select("part").distinct()
        met = rows.join(F.broadcast(wanted), "part", "left_semi").select("part", "asked", "id", "v")  # parts: below MAX_ANNULI
        sorted_rows = met.repartition(max(1, min(len(directory.parts), 4096)), "part").sortWithinPartitions("part", "asked")
        found = _answers(sorted_rows, k, width)
        if best is not None:
            found = found.unionByName(best)
        best = materialise(_ranked(found, k).filter(F.col("rank") <= k).drop("rank"), "pivot-best")
        floors = best.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("_n"))
        open_queries = queries.join(floors, "query_id", "left").select(
            "query_id", "v", F.when(F.col("_n") >= k, F.col("floor")).alias("floor")
        )
        skip, take = skip + take, take * GROWTH
    if best is None:
        return vectors.sparkSession.createDataFrame([], schema)
    return _ranked(best, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order))
