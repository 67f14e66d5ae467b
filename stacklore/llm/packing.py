"""Pack documents into fixed token sequences along a space-filling curve.

A text's hashed vector counts its byte pairs in 65,536 places; a seeded random projection
takes it to DIMENSIONS coordinates, each ranked by a normal curve with the mean and deviation
of all documents, and a Hilbert curve through that cube gives the order. Documents are cut
into ranges of about RANGE_BYTES of text along the curve; each range is one task and one stream
of tokens that is cut every `length` tokens. So neighbours on the curve share sequences, a
document's pieces follow one another, and only the last sequence of a range is padded: less
than one sequence in RANGE_BYTES of text.

Passes: coordinates of all texts, written beside them; one shuffle of (key, bytes), sorted, in
which each task names the keys where another RANGE_BYTES are full; one shuffle of the texts by
range, sorted within. Texts are tokenised once, after it, while streaming. The key ends in a
hash of the id and the row's place, so copies of one text spread over ranges like other rows.
The driver gets the means and one key per RANGE_BYTES of text, whatever the size of the table.

Defined cases: an added token of the vocabulary (`<|endoftext|>`) spelt in a text is that token,
as the tokenizer's own encoding has it; null and empty texts are one closing token; null ids are packed like others;
rows repeated with one id are packed once each; an empty table gives no rows; other columns
do not matter.
"""

from __future__ import annotations

import base64
import json
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklore.session import materialise

LENGTH = 2048
END_TOKEN = 1
DIMENSIONS = 3
BITS = 10
SEED = 20
RANGE_BYTES = 8 << 20
TIE_BITS = 63 - DIMENSIONS * BITS
CHUNK = 1 << 20
PLACE = ["size", "tie", *[f"x{i}" for i in range(DIMENSIONS)]]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_tokenizer(path: str):
    """The byte-level BPE of byte_bpe_50k.json from its rank file: same ids, a third of the time."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path)
    )


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that count as one wherever a text spells them, from the json beside the rank file."""
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']} of {beside} is not matched as it is spelt")
    return {token["content"]: token["id"] for token in added}


def projection() -> np.ndarray:
    drawn = np.random.default_rng(SEED).standard_normal((1 << 16, DIMENSIONS)).astype(np.float32)
    return np.ascontiguousarray(drawn.T)


def coordinates(data: bytes, weights: np.ndarray) -> list[float]:
    """Mean projection of a text's byte pairs; `weights` has one contiguous row per dimension."""
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(data) - 1, CHUNK):
        part = np.frombuffer(data[at:at + CHUNK + 1], np.uint8).astype(np.uint16)
        pairs = (part[:-1] << 8) | part[1:]
        total += [row[pairs].sum(dtype=np.float64) for row in weights]
    return (total / max(1, len(data) - 1)).tolist()


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows, dimensions), by undoing the curve's turns bit by bit."""
    x = points.astype(np.int64).copy()
    dimensions = x.shape[1]
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(dimensions):
            turned = (x[:, i] & q) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, i] ^= swap
    for i in range(1, dimensions):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dimensions):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


def _cells(points: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    z = (points - mean) / np.where(deviation > 0, deviation, 1.0)
    share = 0.5 * (1 + np.vectorize(math.erf)(np.clip(z, -6, 6) / math.sqrt(2)))
    return np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def curve_keys(points: np.ndarray, ties: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    return (hilbert(_cells(points, mean, deviation), BITS) << TIE_BITS) | (ties & ((1 << TIE_BITS) - 1))


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) with bytes, tie and coordinates."""
    weights = projection()
    for batch in batches:
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column(1).to_pylist()]
        points = np.array([coordinates(t, weights) for t in texts]).reshape(-1, DIMENSIONS)
        # The place in the batch parts rows repeated with one id.
        ties = [zlib.crc32(f"{i}:{at}".encode()) for at, i in enumerate(batch.column(0).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([len(t) for t in texts], pa.int64()), pa.array(ties, pa.int64()),
             *[pa.array(points[:, i]) for i in range(DIMENSIONS)]],
            names=["doc_id", "text", *PLACE],
        )


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(DIMENSIONS)], axis=1)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, size), the keys at which another RANGE_BYTES are full."""
    size = 0
    for batch in batches:
        sizes = size + np.cumsum(batch.column(1).to_numpy(zero_copy_only=False))
        full = np.flatnonzero(np.diff(sizes // RANGE_BYTES, prepend=size // RANGE_BYTES))
        size = int(sizes[-1]) if len(sizes) else size
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full))], names=["key"])


def pack(
    docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    chosen = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    names = PLACE[2:]
    place = "size long, tie long, " + ", ".join(f"{n} double" for n in names)
    located = materialise(chosen.mapInArrow(_located, f"doc_id {kind}, text string, {place}"), "pack-coordinates")
    stats = located.agg(
        *[F.avg(n).alias(f"m{n}") for n in names], *[F.stddev_pop(n).alias(f"d{n}") for n in names]
    ).first()
    mean = np.array([stats[f"m{n}"] or 0.0 for n in names])
    deviation = np.array([stats[f"d{n}"] or 0.0 for n in names])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curve_keys(_points(batch), batch.column("tie").to_numpy(zero_copy_only=False), mean, deviation)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("size")], names=["key", "size"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = located.select(*PLACE).mapInArrow(keyed, "key long, size long")
    cuts = narrow.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(_cuts, "key long")
    bounds = np.array(sorted({r[0] for r in cuts.collect()}), np.int64)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curve_keys(_points(batch), batch.column("tie").to_numpy(zero_copy_only=False), mean, deviation)
            part = np.searchsorted(bounds, keys, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(part), pa.array(keys)], names=["doc_id", "text", "range", "key"]
            )

    placed = located.mapInArrow(ranged, f"doc_id {kind}, text string, range int, key long")
    ordered = placed.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("range", "key", "doc_id")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        current, sequence, used = None, 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, content, part in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if part != current:
                    current, sequence, used = part, 0, 0
                data = np.append(tokenizer.encode_to_numpy(content or "", allowed_special="all"), END_TOKEN).astype("<u4")
                at = 0
                while at < len(data):
                    if used == length:
                        sequence, used = sequence + 1, 0
                    n = min(length - used, len(data) - at)
                    crc = zlib.crc32(data[at:at + n].tobytes())
                    rows.append((doc_id, at, n, crc, len(data), (part << 40) | sequence, used))
                    at, used = at + n, used + n
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ordered.mapInArrow(
        fill,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
