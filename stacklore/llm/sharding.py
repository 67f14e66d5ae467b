"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

DataFrame functions only. Rows are numbered in the order of (doc_id, text checksum, size);
the permutation maps number x below N to another number below N, and that place gives shard
`place % shards` and slot `place // shards`: counts differ by one at most, and both are
computed from x, N and the seed alone, in any job.

The permutation works on the grid a * b just above N (a is about the root of N): L += F(R)
mod a and R += F(L) mod b in turn. Fewer than a + b places of the grid lie outside N; a
number that lands there walks on along its cycle until it is inside, which takes at most as
many steps as there are outside places.

Defined cases: null texts have 8 bytes (the size adds 8) and checksum 0; null ids come first;
equal rows are numbered in any order, which leaves the result's rows the same; an empty table
gives no rows; other columns are carried by `shard_rows` under their own names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.llm.common import renamed_apart, text_of, with_row_numbers

MASK = (1 << 31) - 1
MULTIPLIERS = (0x2C1B3C6D, 0x297A2D39)  # odd, below 2**31: products stay within a long
ROUNDS = 6
EXTRA_BYTES = 8


def grid(n: int) -> tuple[int, int]:
    side = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return side, max(1, -(-n // side))


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [((seed + 1) * 0x1F123BB5 + r * 0x5BD1E995) & MASK for r in range(rounds)]


def _mixed(value: Column, key: Column) -> Column:
    x = (value + key).bitwiseAND(F.lit(MASK))
    for multiplier in MULTIPLIERS:
        x = (x.bitwiseXOR(F.shiftright(x, 15)) * F.lit(multiplier)).bitwiseAND(F.lit(MASK))
    return x.bitwiseXOR(F.shiftright(x, 13))


def feistel_rounds(seed: int, a: int, b: int) -> Callable[[Column], Column]:
    """One application of the permutation of [0, a * b).

    The rounds run as `aggregate` over the array of round keys, so the expression does not
    double with each round.
    """
    keys = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(i % 2 == 0).alias("left"))
                     for i, k in enumerate(round_keys(seed))])

    def step(state: Column, key: Column) -> Column:
        left = F.when(key["left"], (state["l"] + _mixed(state["r"], key["k"])) % a).otherwise(state["l"])
        right = F.when(key["left"], state["r"]).otherwise((state["r"] + _mixed(state["l"], key["k"])) % b)
        return F.struct(left.alias("l"), right.alias("r"))

    def apply(x: Column) -> Column:
        start = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))
        return F.aggregate(keys, start, step, lambda s: s["r"] * a + s["l"])

    return apply


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """The place of row `number` among n: one application, then walking while outside."""
    a, b = grid(n)
    apply = feistel_rounds(seed, a, b)
    outside = a * b - n
    first = apply(number)
    if not outside:
        return first
    return F.aggregate(
        F.array(first), F.lit(0).cast("long"),
        lambda _, x: F.when(x < n, x).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.lit(outside)), x, lambda y, _i: F.when(y < n, y).otherwise(apply(y)))
        ),
    )


def shard_rows(rows: DataFrame, order: list[str], shards: int = 24, seed: int = 0) -> DataFrame:
    """`rows` with shard and slot; `order` decides the global row numbers.

    Columns of `rows` named shard or slot give way to the new ones; others keep any name.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = rows.drop("shard", "slot")
    columns = rows.columns
    apart, order = renamed_apart(rows, *order)
    numbered, n = with_row_numbers(apart, order, "shard-rows", "_row")
    placed = numbered.withColumn("_place", permuted(F.col("_row"), n, seed)).drop("_row")
    return (
        placed.withColumn("shard", (F.col("_place") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("_place") / shards).cast("long"))
        .drop("_place")
    ).toDF(*columns, "shard", "slot")


def document_keys(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): all that the numbering needs, so whole texts are not moved."""
    content = text_of(docs, text)
    return docs.select(
        docs[id_column].alias("doc_id"),
        (F.octet_length(content).cast("long") + EXTRA_BYTES).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
