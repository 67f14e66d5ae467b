"""Cut a question table into blocks of a checked size.

A block is what a search broadcasts. Blocks are filled up to a row limit, so what is
broadcast never grows with the number of questions; more questions mean more blocks, and
every question is in exactly one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.session import materialise

BUCKETS = 4096


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def question_blocks(df: DataFrame, key: str, max_rows: int) -> list[DataFrame]:
    """Split `df` into DataFrames of at most `max_rows` rows; rows of one key stay together.

    Only bucket counts (at most 4096 numbers) reach the driver. A bucket beyond the limit
    is split again on a second hash.
    """
    counts = df.groupBy(_bucket(key).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sorted((r.b, r.n) for r in counts.collect())
    if sum(n for _, n in sizes) <= max_rows:
        return [df] if sizes else []
    blocks: list[DataFrame] = []
    group: list[int] = []
    filled = 0
    for bucket, n in sizes:
        if n > max_rows:
            blocks.extend(_split_bucket(df.filter(_bucket(key) == bucket), key, n, max_rows))
            continue
        if filled + n > max_rows:
            blocks.append(df.filter(_bucket(key).isin(group)))
            group, filled = [], 0
        group.append(bucket)
        filled += n
    if group:
        blocks.append(df.filter(_bucket(key).isin(group)))
    return blocks


def split_large(df: DataFrame, key: str, part: str, max_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of the keys with at most `max_rows` rows, and the others in blocks.

    The others' rows are dealt by (`key`, `part`), so one key's rows are in several blocks, and
    what is computed from them is added up over the blocks.
    """
    large = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(key)
    if large.isEmpty():
        return df, []
    large = materialise(large, "large-keys")
    dealt = df.join(large, key, "left_semi").withColumn("_dealt", F.struct(key, part))
    return df.join(large, key, "left_anti"), [b.drop("_dealt") for b in question_blocks(dealt, "_dealt", max_rows)]


def _split_bucket(df: DataFrame, key: str, rows: int, max_rows: int) -> list[DataFrame]:
    parts = 2 * (-(-rows // max_rows))
    part = F.pmod(F.xxhash64(F.lit("split"), key), F.lit(parts))
    largest = df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if largest > max_rows:
        if parts > 64 * max(1, rows // max_rows) or df.select(key).distinct().count() == 1:
            raise ValueError(f"one {key} holds more than {max_rows} rows")
        return [b for i in range(parts) for b in question_blocks(df.filter(part == i), key, max_rows)]
    return [df.filter(part == i) for i in range(parts)]
