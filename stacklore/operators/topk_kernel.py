"""Arrow kernel for exact dense search: one pass over the index, k rows per question out.

Runs inside `mapInArrow` tasks. Spark partitions the index; the questions of one block are
small and travel with the task. A task keeps a running top-k per question, so neither a
question-document pair nor a whole partition is ever materialised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SCORE_DIGITS = 9
# Sums of documents and questions, and postings met by them, that a task holds at a time.
CELLS = 2**20
# No question is met below; a sum of positive weights may be rounded to nothing.
SMALLEST = 0.0


@dataclass(frozen=True)
class QuestionBlock:
    ids: pa.Array
    vectors: np.ndarray  # (questions, dimensions), unit length
    cells: list[frozenset[int]] | None = None  # per question: index cells to look into


@dataclass(frozen=True)
class TermWeights:
    """Questions of one block by number of term: those of term t are at start[t] up to start[t + 1]."""

    ids: pa.Array
    start: np.ndarray
    question: np.ndarray
    weight: np.ndarray


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if lengths.size and (lengths.size > 1 or lengths[0] != dimensions):
        raise ValueError(f"expected vectors of {dimensions} values, found lengths {lengths.tolist()}")
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dimensions)


def top_k_batches(
    batches: Iterator[pa.RecordBatch], block: QuestionBlock, k: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Best k documents of this partition per question: (question, document, score).

    Batches hold (document id, vector[, cell]). Equal scores are ordered by id.
    """
    n_questions, dimensions = block.vectors.shape
    best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_questions
    for batch in batches:
        batch = batch.filter(batch.column(1).is_valid())
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        vectors = unit_rows(_matrix(batch.column(1), dimensions))
        scores = np.round(vectors @ block.vectors.T, SCORE_DIGITS).T
        cells = batch.column(2).to_numpy(zero_copy_only=False) if batch.num_columns > 2 else None
        for q in range(n_questions):
            allowed = ~np.isnan(scores[q])
            if cells is not None:
                allowed &= np.isin(cells, list(block.cells[q]))
            best[q] = _merge(best[q], ids[allowed], scores[q][allowed], k)
    yield from _found(best, block.ids, schema)


def best_documents(
    batches: Iterator[pa.RecordBatch], asked: TermWeights, k: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Best k documents of this partition per question by summed term weights: (question, document, score).

    Batches hold (document id, term numbers, weights[, open]): a document's postings in two lists, and, if
    given, as bits of 64-bit words the questions it may be scored for. Sums are made for few documents at a time.
    """
    n_questions = len(asked.ids)
    best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_questions
    least = np.full(n_questions, SMALLEST)  # scores below cannot enter
    at_once = max(1, CELLS // max(1, n_questions))
    for batch in batches:
        for part in (batch.slice(at, at_once) for at in range(0, batch.num_rows, at_once)):
            scores = np.round(_sums(part, asked, n_questions), SCORE_DIGITS)
            ids = _ids(part.column(0))
            near = scores >= least
            for q in np.flatnonzero(near.any(axis=0)):
                best[q] = _merge(best[q], ids[near[:, q]], scores[near[:, q], q], k)
                if len(best[q][1]) == k:
                    least[q] = best[q][1][-1]
    yield from _found(best, asked.ids, schema)


def _sums(part: pa.RecordBatch, asked: TermWeights, n_questions: int) -> np.ndarray:
    """(documents, questions): the summed weights, -1 where a document has no term of a question."""
    terms, weights = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
    rows = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
    allowed = None
    if part.num_columns > 3:
        words = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
        allowed = np.unpackbits(words.astype("<i8").view(np.uint8), axis=1, bitorder="little")[:, :n_questions].astype(bool)
    sums, met = (np.zeros(part.num_rows * n_questions) for _ in range(2))
    # Few postings at a time: each is repeated for the questions with its term.
    sizes = asked.start[terms + 1] - asked.start[terms]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(terms):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")))
        n = sizes[at:stop]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        index = np.repeat(asked.start[terms[at:stop]], n) + within
        row, question = np.repeat(rows[at:stop], n), asked.question[index]
        value = np.repeat(weights[at:stop], n) * asked.weight[index]
        if allowed is not None:
            kept = allowed[row, question]
            row, question, value = row[kept], question[kept], value[kept]
        cell = row * n_questions + question
        sums += np.bincount(cell, value, len(sums))
        met[cell] = 1
        at = stop
    return np.where(met > 0, sums, -1.0).reshape(part.num_rows, n_questions)


def _ids(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _found(best: list, ids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    found = [(i, scores) for i, scores in (b or (np.empty(0), np.empty(0)) for b in best)]
    sizes = [len(scores) for _, scores in found]
    if sum(sizes):
        rows = np.repeat(np.arange(len(best)), sizes)
        doc_ids = [i for of_question, _ in found for i in of_question.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(rows)).cast(schema.field(0).type),
                pa.array(doc_ids, type=schema.field(1).type),
                pa.array(np.concatenate([scores for _, scores in found]).astype(np.float64)),
            ],
            schema=schema,
        )


def _merge(best, ids: np.ndarray, scores: np.ndarray, k: int):
    """Running best k with new candidates; equal scores go to the smaller id.

    Candidates that cannot enter are cut by whole-array comparisons first, so a large
    group of copies, all with one score, costs no more than other rows.
    """
    if best is not None and len(best[1]) == k:
        worst_id, worst = best[0][-1], best[1][-1]
        near = scores >= worst
        ids, scores = ids[near], scores[near]
        better = (scores > worst) | (ids < worst_id)
        ids, scores = ids[better], scores[better]
    if len(scores) > k:
        floor = -np.partition(-scores, k - 1)[k - 1]
        above = scores > floor
        tied_ids = np.sort(ids[scores == floor])[: k - int(above.sum())]
        ids = np.concatenate([ids[above], tied_ids])
        scores = np.concatenate([scores[above], np.full(len(tied_ids), floor)])
    if best is not None:
        ids, scores = np.concatenate([best[0], ids]), np.concatenate([best[1], scores])
    order = np.lexsort((_ranks(ids), -scores))[:k]
    return ids[order], scores[order]


def _ranks(ids: np.ndarray) -> np.ndarray:
    """Sort positions of at most 2k ids, numbers or texts."""
    return np.unique(ids, return_inverse=True)[1]
