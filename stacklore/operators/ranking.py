"""Ranking that never sorts a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklore.operators.joins import counted


def sort_key(name: str, direction: str) -> Column:
    """NULL counts as the largest value in both directions."""
    column = F.col(name)
    return column.desc_nulls_first() if direction == "desc" else column.asc_nulls_last()


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first `k` rows of every group, numbered from 1.

    The literal bound gives a WindowGroupLimit on both sides of the shuffle, so a task
    sends at most `k` rows per group.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def rank_in_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[tuple[str, str]],
    bucket: Column,
    out: str = "rank",
) -> DataFrame:
    """SQL `RANK()` for every row, for few large groups.

    A window partitioned by `by` would sort each group in one task. Here the rows are
    first counted per distinct sort key (map-side combine), the counts are summed up in
    two levels, and the rank is joined back, by broadcast when the counted sort keys are
    few. `df` is read twice, so pass a stored table.

    * `bucket` must be a coarse, order-preserving expression of the last sort column, for
      example its value in thousands;
    * one window per group runs over buckets, one window per bucket runs over the sort
      keys inside it. Neither grows with the number of rows.
    """
    names = [name for name, _ in order]
    *head, (last, last_dir) = order
    head_names = [name for name, _ in head]
    counts = df.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", bucket)

    group = [*by, *head_names, "_bucket"]
    coarse_order = [*(sort_key(n, d) for n, d in head), sort_key("_bucket", last_dir)]
    coarse_window = (
        Window.partitionBy(*by).orderBy(*coarse_order).rowsBetween(Window.unboundedPreceding, -1)
    )
    fine_window = (
        Window.partitionBy(*group)
        .orderBy(sort_key(last, last_dir))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        counts.groupBy(*group)
        .agg(F.sum("_n").alias("_bucket_n"))
        .withColumn("_start", F.coalesce(F.sum("_bucket_n").over(coarse_window), F.lit(0)))
    )
    fine = counts.withColumn("_within", F.coalesce(F.sum("_n").over(fine_window), F.lit(0)))
    ranks = null_safe_join(fine, starts, group, "inner").select(
        *by, *names, (F.col("_start") + F.col("_within") + 1).alias(out)
    )
    return null_safe_join(df, counted(ranks, "ranks"), [*by, *names], "inner")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL; right-hand key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in keys))
