"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are hashed pairs of neighbouring character classes, over the whole text, and
bands of a few of its rates (repeated words and lines, capitals, signs, word length, size).
Term weights are log counts times inverse document frequency; a truncated SVD of the labelled
sample's term matrix gives the latent space. Labelled vectors are broadcast: at most
MAX_ROWS * DIMENSIONS doubles. Every document is projected, its cosines with all labelled
vectors are exact blocked matrix products, and its score is the similarity-weighted share of
label 1 among the nearest NEIGHBOURS, ties to the earlier labelled row.

Fitted on at most MAX_ROWS labelled rows (by smallest hash of the id, outside the held-out
fold); scoring reads every row and whole texts. Defined cases: null and empty texts have the
terms of an empty text and get a score as any other; without labelled rows every score is 0.5;
a text whose vector is zero gets the sample's share of label 1; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stacklore.llm.toxicity import training_rows
from stacklore.session import materialise

MAX_ROWS = 4_000
DIMENSIONS = 24
NEIGHBOURS = 15
SHARPNESS = 8  # power of the cosine in a vote
BLOCK = 512  # documents per matrix product
CLASSES = 32
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """Class of each byte: letters in 8 small and 4 capital groups, digits, blanks, signs one by one."""
    classes = np.zeros(256, np.uint16)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            classes[b] = 1 + (b >= 0xC0)
        elif "a" <= c <= "z":
            classes[b] = 3 + (b - 97) % 8
        elif "A" <= c <= "Z":
            classes[b] = 11 + (b - 65) % 4
        elif c.isdigit():
            classes[b] = 15
        elif c == " ":
            classes[b] = 16
        elif c in "\r\n\t\v\f":
            classes[b] = 17
        elif b > 32:
            classes[b] = 18 + (b * 7) % 14
    return classes


BYTE_CLASS = _byte_classes()
PAIRS = CLASSES * CLASSES
RATE_BANDS = 12
RATES = 7
TERMS = PAIRS + RATES * RATE_BANDS


def rates(text: str) -> list[float]:
    words = text.split()
    lines = text.split("\n")
    n, size = max(1, len(words)), max(1, len(text))
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        1 - len(set(words)) / n,
        same / n,
        1 - len(set(lines)) / len(lines),
        sum(map(str.isupper, words)) / n,
        min(1.0, len(text) / n / 20),
        min(1.0, np.log2(1 + n) / 16),
        min(1.0, 8 * (text.count("|") + text.count("#") + text.count("$") + text.count("%") + text.count("!")) / size),
    ]


def terms(text: str | None) -> np.ndarray:
    """Dense term counts, logged: pairs per 1,000 characters and bands of rates."""
    content = text or ""
    codes = BYTE_CLASS[np.frombuffer(content.encode("utf-8", "replace"), np.uint8)]
    out = np.zeros(TERMS)
    if len(codes) > 1:
        pairs = np.bincount(codes[:-1] * np.uint16(CLASSES) + codes[1:], minlength=PAIRS)
        out[:PAIRS] = np.log1p(pairs * (1000.0 / len(codes)))
    for i, rate in enumerate(rates(content)):
        place = rate * (RATE_BANDS - 1)
        low = int(place)
        at = PAIRS + i * RATE_BANDS + low
        out[at] += 4 * (1 - (place - low))
        if low + 1 < RATE_BANDS:
            out[at + 1] += 4 * (place - low)
    return out


@dataclass
class Voters:
    weights: np.ndarray  # inverse document frequencies times the right singular vectors, (terms, dimensions)
    vectors: np.ndarray  # (labelled rows, dimensions), unit length
    labels: np.ndarray
    prior: float


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def build(matrix: np.ndarray, labels: np.ndarray) -> Voters | None:
    if not len(labels):
        return None
    frequency = (matrix > 0).mean(axis=0)
    idf = 1 + np.log(1 / np.maximum(frequency, 1 / (1 + len(labels))))
    weighted = _unit(matrix * idf)
    values, vectors = np.linalg.eigh(weighted.T @ weighted)
    top = vectors[:, np.argsort(-values)[:DIMENSIONS]]
    weights = idf[:, None] * top
    return Voters(weights, _unit(matrix @ weights), labels.astype(np.float64), float(labels.mean()))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, folds: int = 5, fold_no: int = 0) -> Voters | None:
    """Term vectors of the sample are computed where its rows are; the driver gets
    `max_rows` rows of TERMS numbers at most."""
    sample = materialise(training_rows(docs, labels, "quality", folds, fold_no, max_rows), "voter-rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [terms(t).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2), pa.array(packed, pa.binary())],
                names=["doc_id", "label", "terms"],
            )

    rows = sample.mapInArrow(run, "doc_id string, label int, terms binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["terms"]))
    matrix = np.array([np.frombuffer(r["terms"], np.float32) for r in rows], np.float64).reshape(-1, TERMS)
    return build(matrix, np.array([r["label"] for r in rows]))


def vote(vectors: np.ndarray, voters: Voters) -> np.ndarray:
    """Scores of a block of unit vectors: exact products with every labelled vector."""
    cosines = vectors @ voters.vectors.T
    # Equal vectors have equal cosines but for the last digits, which depend on their place in a block.
    cosines = np.round(cosines, 9)
    k = min(NEIGHBOURS, len(voters.labels))
    least = np.partition(cosines, len(voters.labels) - k, axis=1)[:, [len(voters.labels) - k]]
    above, tied = cosines > least, cosines == least
    near = above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    weight = np.where(near, np.maximum(cosines, 0.0), 0.0) ** SHARPNESS
    total = weight.sum(axis=1)
    share = weight @ voters.labels
    return np.where(total > 0, share / np.where(total > 0, total, 1), voters.prior)


def score(docs: DataFrame, voters: Voters | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if voters is not None:
                for at in range(0, batch.num_rows, BLOCK):
                    block = np.array([terms(t) for t in batch.column(1).slice(at, BLOCK).to_pylist()])
                    scores[at:at + BLOCK] = vote(_unit(block @ voters.weights), voters)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, score double")
