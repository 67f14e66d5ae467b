"""Dense search: exact cosine top-k over a vector column, and an approximate form by cells."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stacklore.operators.blocks import question_blocks
from stacklore.operators.ranking import top_k
from stacklore.operators.topk_kernel import QuestionBlock, top_k_batches, unit_rows
from stacklore.session import materialise

# Vectors per question block: 512 vectors of 1,024 doubles are 4 MB per task.
BLOCK_VECTORS = 512
Embedder = Callable[[pd.Series], pd.Series]


@dataclass(frozen=True)
class DenseIndex:
    """Documents with one vector each; `centroids` is set when rows carry a `cell`."""

    rows: DataFrame
    id_col: str
    vector_col: str = "embedding"
    centroids: tuple[tuple[float, ...], ...] | None = None


def embed(df: DataFrame, text_col: str, embedder: Embedder, out: str = "embedding") -> DataFrame:
    """Add a vector column computed by a batch function from texts to lists of floats."""
    udf = F.pandas_udf(_typed(embedder), T.ArrayType(T.FloatType()))
    return df.withColumn(out, udf(F.col(text_col)))


def _typed(embedder: Embedder):
    """`embedder` as a named function with the type hints a pandas UDF is made from."""

    def body(texts: pd.Series) -> pd.Series:
        return embedder(texts)

    # Annotations are strings in this module; the UDF wants the types themselves.
    body.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return body


def build_dense_index(docs: DataFrame, id_col: str, vector_col: str = "embedding") -> DenseIndex:
    return DenseIndex(docs, id_col, vector_col)


def search_dense(
    questions: DataFrame,
    index: DenseIndex,
    k: int = 5,
    where: Column | None = None,
    qid: str = "qid",
    vector_col: str = "vector",
    probes: int | None = None,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """(qid, doc_id, score, rank): the k rows closest to every question by cosine.

    One pass over the index per question block, no join and no shuffle of index rows: only
    k rows per question and task are shuffled. `where` filters documents at the scan,
    before scoring. With `probes` (index with cells) each question looks into that many
    nearest cells only.
    """
    rows = index.rows if where is None else index.rows.filter(where)
    if probes is not None and index.centroids is None:
        raise ValueError("probes need an index with cells")
    id_type, q_type = index.rows.schema[index.id_col].dataType, questions.schema[qid].dataType
    out = T.StructType(
        [
            T.StructField("qid", q_type),
            T.StructField("doc_id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    found: list[DataFrame] = []
    # Written once: the blocks are counted and read from it.
    # Questions without a vector match nothing and fill no block.
    asked = materialise(questions.filter(F.col(vector_col).isNotNull()).select(qid, vector_col), "question-vectors")
    for part in question_blocks(asked, qid, block_vectors):
        block = _collect_block(part, qid, vector_col)
        picked = rows.select(index.id_col, index.vector_col)
        if probes is not None:
            block = _with_cells(block, index.centroids, probes)
            probed = sorted(set().union(*block.cells))
            picked = rows.filter(F.col("cell").isin(probed)).select(
                index.id_col, index.vector_col, "cell"
            )
        found.append(picked.mapInArrow(_kernel(block, k, to_arrow_schema(out)), out))
    if not found:
        return questions.sparkSession.createDataFrame([], out).withColumn("rank", F.lit(1))
    hits = reduce(DataFrame.unionByName, found)
    return top_k(hits, ["qid"], [F.desc("score"), F.asc("doc_id")], k)


def _collect_block(part: DataFrame, qid: str, vector_col: str) -> QuestionBlock:
    # At most `block_vectors` rows, checked by question_blocks.
    table = part.filter(F.col(vector_col).isNotNull()).toArrow().combine_chunks()
    vectors = np.array(table.column(vector_col).to_pylist(), dtype=np.float64)
    ids = table.column(qid)
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return QuestionBlock(ids, unit_rows(vectors.reshape(len(ids), -1)))


def _with_cells(block: QuestionBlock, centroids, probes: int) -> QuestionBlock:
    closeness = block.vectors @ unit_rows(np.array(centroids, dtype=np.float64)).T
    nearest = np.argsort(-closeness, axis=1, kind="stable")[:, :probes]
    return replace(block, cells=[frozenset(row.tolist()) for row in nearest])


def _kernel(block: QuestionBlock, k: int, schema: pa.Schema):
    def run(batches):
        yield from top_k_batches(batches, block, k, schema)

    return run


def build_cells(index: DenseIndex, cells: int, seed: int = 7, max_iter: int = 10) -> DenseIndex:
    """Group index rows into cells of similar direction, for approximate search.

    K-means on unit vectors. The number of cells is a parameter, so the centroids are
    bounded. Rows stay where they are: a cell with a third of all rows is spread over as
    many tasks as its rows fill, because search scans and never shuffles by cell. The rows
    are written once, sorted by cell within each file, so that a search skips row groups.
    """
    length = F.sqrt(
        F.aggregate(index.vector_col, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    )
    unit = F.transform(index.vector_col, lambda x: x.cast("double") / F.col("_length"))
    # A zero vector has no direction and no cosine, so it can never be a hit.
    rows = index.rows.withColumn("_length", length).filter("coalesce(_length, 0D) > 0")
    rows = rows.withColumn("_unit", array_to_vector(unit)).drop("_length")
    model = KMeans(
        k=cells, seed=seed, maxIter=max_iter, featuresCol="_unit", predictionCol="cell"
    ).fit(rows)
    centroids = tuple(tuple(float(x) for x in c) for c in model.clusterCenters())
    assigned = model.transform(rows).drop("_unit").sortWithinPartitions("cell")
    return replace(index, rows=materialise(assigned, "cells"), centroids=centroids)


def hashing_embedder(dimensions: int = 64) -> Embedder:
    """A deterministic stand-in for a trained model: signed token hashing, unit length."""

    def embedder(texts: pd.Series) -> pd.Series:
        import re
        import zlib

        def one(text):
            if text is None:
                return None
            vector = np.zeros(dimensions)
            for token in re.findall(r"[^\W_]+", text.lower()):
                code = zlib.crc32(token.encode("utf-8"))
                vector[code % dimensions] += 1.0 if (code >> 16) & 1 else -1.0
            length = np.linalg.norm(vector)
            return (vector / length if length else vector).astype(np.float32).tolist()

        return texts.map(one)

    return embedder
