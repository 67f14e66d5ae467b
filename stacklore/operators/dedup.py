"""One row per key.

`row_number() = 1` lets Catalyst place a WindowGroupLimit before the shuffle: every task
first cuts its own rows to one per key, so a key holding a third of the table sends one
row per task across the network instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.operators.joins import BROADCAST_ROWS, counted
from stacklore.session import materialise


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def first_row(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under `order`; NULL keys form one group."""
    window = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_order(
    df: DataFrame, keys: str | Sequence[str], order_by: str, tiebreak: Sequence[str] | None = None
) -> list[Column]:
    """Newest first with NULL as newest, then the tie-break columns ascending.

    The default tie-break is every other column, which makes the surviving row unique up
    to identical duplicates whatever the partitioning.
    """
    if tiebreak is None:
        skip = {*_names(keys), order_by}
        tiebreak = [f.name for f in df.schema if f.name not in skip and _orderable(f.dataType)]
    return [F.col(order_by).desc_nulls_first(), *(F.col(c).asc_nulls_last() for c in tiebreak)]


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: str, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """The most recent row of every key."""
    return first_row(df, keys, latest_order(df, keys, order_by, tiebreak))


def latest_then_wide(df: DataFrame, keys: str | Sequence[str], order_by: str, wide: Sequence[str]) -> DataFrame:
    """`latest_per_key` for rows with long columns, `wide`, that break ties last.

    The other columns alone go through the window; the winners are written, and the rows of
    `df` that equal one of them are taken with their long columns. Those are sorted only
    where several rows are equal in everything else, repeated rows for instance.
    """
    narrow = [c for c in df.columns if c not in wide]
    columns = df.select(*narrow)
    first = counted(first_row(columns, keys, latest_order(columns, keys, order_by)), "latest-narrow")

    def equal_to(rows: DataFrame, winners: DataFrame, how: str) -> DataFrame:
        winners = winners.select(*(F.col(c).alias(f"_won_{c}") for c in narrow))
        return rows.join(winners, reduce(Column.__and__, [rows[c].eqNullSafe(winners[f"_won_{c}"]) for c in narrow]), how)

    met = equal_to(columns, first, "left_semi").groupBy(*narrow).agg(F.count(F.lit(1)).alias("_met"))
    several = counted(met.filter("_met > 1").drop("_met"), "latest-tied")
    if several.isEmpty():
        return equal_to(df, first, "left_semi")
    tied = first_row(equal_to(df, several, "left_semi"), keys, [F.col(c).asc_nulls_last() for c in wide])
    alone = counted(equal_to(first, several, "left_anti"), "latest-alone")
    return equal_to(df, alone, "left_semi").unionByName(tied)


def latest_links(
    df: DataFrame, keys: str | Sequence[str], order_by: str, link: str, lookup: DataFrame, wide: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): the latest row of every key with its `link`, and `lookup` (link, *wide) with one row per link.

    The rows of `df` are shuffled once, without the long columns. Those break ties last: they are read and sorted
    only where a key has several rows equal in everything else, or `lookup` several of one `link`.
    """
    narrow = df.drop(link)
    newest = F.rank().over(Window.partitionBy(*_names(keys)).orderBy(*latest_order(narrow, keys, order_by)))
    ties = df.withColumn("_rank", newest).filter("_rank = 1").drop("_rank").distinct()
    found = materialise(ties.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*_names(keys)))), "latest-narrow")

    texts = lookup.select(link, *wide).filter(F.col(link).isNotNull())
    if found.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(found.select(link).distinct()), link, "left_semi")
    order = [F.col(c).asc_nulls_last() for c in wide]
    repeated = counted(texts.groupBy(link).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(link), "latest-links")
    if not repeated.isEmpty():
        several = first_row(texts.join(repeated, link, "left_semi"), link, order)
        texts = texts.join(repeated, link, "left_anti").unionByName(several).repartition(link)

    alone, tied = found.filter("_n = 1").drop("_n"), found.filter("_n > 1").drop("_n")
    if not tied.isEmpty():
        settled = first_row(with_lookup(tied, texts, link), keys, order).drop(*wide)
        alone = alone.unionByName(materialise(settled, "latest-tied"))
    return alone, texts


def with_lookup(rows: DataFrame, texts: DataFrame, link: str) -> DataFrame:
    """`rows`, which are narrow, with what `texts` has for their `link`, NULL where it has none.

    The rows are hashed, so that the texts are dealt but never sorted.
    """
    return rows.hint("shuffle_hash").join(texts, link, "left")


def latest_then_lookup(
    df: DataFrame, keys: str | Sequence[str], order_by: str, link: str, lookup: DataFrame, wide: Sequence[str]
) -> DataFrame:
    """`latest_per_key` of `df` left-joined to `lookup` on `link`, without the `link`; its long columns, `wide`, break ties last."""
    return with_lookup(*latest_links(df, keys, order_by, link, lookup, wide), link).drop(link)


def first_seen(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of every key met first when walking the rows in `order_by` order."""
    return first_row(df, keys, [F.col(c).asc_nulls_last() for c in order_by])
