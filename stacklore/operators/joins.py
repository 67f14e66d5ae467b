"""Joins whose small side is proven small before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklore.session import materialise

# Rows a derived key or lookup table may have to be broadcast: some 50 MB of narrow rows.
BROADCAST_ROWS = 500_000


def counted(small: DataFrame, label: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Write a narrow derived table once; mark it for broadcast when its counted rows allow.

    A derived table has no size Catalyst could know, so the plan would start by shuffling
    the other, wide side. Beyond the limit the table is returned unmarked and the join is
    a shuffled one.
    """
    written = materialise(small, label)
    return F.broadcast(written) if written.count() <= limit else written


def keep_keys(df: DataFrame, keys: DataFrame, column: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of `df` whose `column` is among `keys` (one column, same name)."""
    wanted = counted(keys.select(F.col(column).alias("_key")), "keys", limit)
    return df.join(wanted, F.col(column) == F.col("_key"), "left_semi")


def require_unique(df: DataFrame, key: str) -> None:
    """Fail when `key` is missing or met twice; only keys are shuffled."""
    several = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(key).isNull())
    first = several.first()
    if first is not None:
        raise ValueError(f"{key} {first[0]!r} is no unique key: {first['_n']} rows")
