"""Approximate cosine search by multi-probe hyperplane tables.

Each table cuts space by random hyperplanes; a row's code in a table is the side it lies on of
each. A question looks into the codes of every table in the order in which it would take the
least to move it there: its distances from the planes that would be crossed, squared and summed.
Rows in any probed code are scored exactly and merged by score; `probes` of all codes give the
exact result.

Codes stay beside their rows and a search scans them: no bucket is shuffled or joined, so one
that holds a third of all rows is spread over as many tasks as its rows fill. Question blocks
and their probed codes (questions * tables * 2**bits bits) travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stacklore.operators.blocks import question_blocks
from stacklore.operators.dense import BLOCK_VECTORS, DenseIndex, _collect_block
from stacklore.operators.ranking import top_k
from stacklore.operators.topk_kernel import QuestionBlock, top_k_batches
from stacklore.session import materialise


@dataclass(frozen=True)
class HyperplaneIndex:
    """Rows with their codes (one per table), and the planes (tables, bits, dimensions)."""

    rows: DataFrame
    id_col: str
    vector_col: str
    planes: np.ndarray


def _codes(distances: np.ndarray) -> np.ndarray:
    """(rows, tables, bits) distances to one code per row and table."""
    return (distances > 0) @ (1 << np.arange(distances.shape[2]))


def build_hyperplanes(index: DenseIndex, tables: int = 16, bits: int = 8, seed: int = 11) -> HyperplaneIndex:
    """Give every row its codes; rows without a vector are left out. Written once."""
    first = index.rows.filter(F.col(index.vector_col).isNotNull()).select(F.size(index.vector_col)).first()
    dimensions = first[0] if first else 1
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dimensions))
    planes /= np.linalg.norm(planes, axis=2, keepdims=True)
    kind = index.rows.schema[index.id_col].dataType.simpleString()
    vector = index.rows.schema[index.vector_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            distances = np.einsum("nd,tbd->ntb", flat.reshape(-1, dimensions), planes)
            codes = _codes(distances).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * tables, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=["id", "vector", "codes"])

    rows = index.rows.filter(F.col(index.vector_col).isNotNull()).select(index.id_col, index.vector_col)
    coded = rows.mapInArrow(run, f"id {kind}, vector {vector}, codes array<int>")
    return HyperplaneIndex(materialise(coded, "hyperplanes"), "id", "vector", planes)


def probed_codes(vectors: np.ndarray, planes: np.ndarray, probes: int) -> np.ndarray:
    """(questions, tables, codes): the `probes` codes of each table that are least to reach."""
    tables, bits, _ = planes.shape
    distances = np.einsum("qd,tbd->qtb", vectors, planes)
    crossed = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    cost = (distances**2) @ crossed.T  # per code, as the difference from the question's own
    order = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]
    chosen = order ^ _codes(distances)[:, :, None]
    found = np.zeros((len(vectors), tables, 1 << bits), bool)
    np.put_along_axis(found, chosen, True, axis=2)
    return found


def _probing(block: QuestionBlock, probed: np.ndarray, k: int, schema: pa.Schema):
    counted = pa.schema([*schema, ("scored", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for q in range(len(block.vectors)):
                near = probed[q][np.arange(codes.shape[1]), codes].any(axis=1)
                one = QuestionBlock(block.ids[q:q + 1], block.vectors[q:q + 1])
                picked = batch.select(["id", "vector"]).filter(pa.array(near))
                for found in top_k_batches(iter([picked]), one, k, schema):
                    scored = pa.array([int(near.sum())] + [0] * (found.num_rows - 1))
                    yield pa.RecordBatch.from_arrays([*found.columns, scored], schema=counted)

    return run


def search_hyperplanes(
    questions: DataFrame, index: HyperplaneIndex, k: int = 5, probes: int = 10, qid: str = "qid", vector_col: str = "vector"
) -> tuple[DataFrame, DataFrame]:
    """((qid, doc_id, score, rank), (qid, scored)): the best rows found, and how many were scored.

    At most k rows per question and Arrow batch are shuffled.
    """
    id_type, q_type = index.rows.schema[index.id_col].dataType, questions.schema[qid].dataType
    out = T.StructType([T.StructField("qid", q_type), T.StructField("doc_id", id_type), T.StructField("score", T.DoubleType())])
    counted = T.StructType([*out, T.StructField("scored", T.LongType())])
    asked = materialise(questions.filter(F.col(vector_col).isNotNull()).select(qid, vector_col), "question-vectors")
    found = []
    for part in question_blocks(asked, qid, BLOCK_VECTORS):
        block = _collect_block(part, qid, vector_col)
        probed = probed_codes(np.nan_to_num(block.vectors), index.planes, probes)
        kernel = _probing(block, probed, k, to_arrow_schema(out))
        found.append(index.rows.select(index.id_col, index.vector_col, "codes").mapInArrow(kernel, counted))
    hits = reduce(DataFrame.unionByName, found) if found else questions.sparkSession.createDataFrame([], counted)
    hits = materialise(hits, "probed")
    best = top_k(hits.drop("scored"), ["qid"], [F.desc("score"), F.asc("doc_id")], k)
    return best, hits.groupBy("qid").agg(F.sum("scored").alias("scored"))
