"""Keep a dense index in step with its documents: only changed rows are embedded and written.

An index folder is a log of versions. A version holds the rows inserted, updated or
deleted since the one before; the current index is the latest row of every key. So an
hourly refresh of a large index writes in proportion to what changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklore.operators.dedup import first_row
from stacklore.operators.dense import DenseIndex, Embedder, embed
from stacklore.operators.joins import keep_keys
from stacklore.session import has_files

UPSERT, DELETE = "upsert", "delete"


def fingerprint(columns: Sequence[str]) -> Column:
    """128 bits over the given columns; NULL and an empty text differ."""
    cells = F.to_json(F.struct(*(F.col(c) for c in columns)), {"ignoreNullFields": "false"})
    return F.md5(cells)


def index_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, change) with change in insert, update, delete; equal rows are left out.

    Both sides are reduced to key and fingerprint and aggregated together, so the shuffle
    carries narrow rows, combines on the map side and forms no pairs. A key met more than
    once counts as the bag of its rows.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key), fingerprint(columns).alias("_fp"), F.lit(name).alias("_side"))

    return _classify(side(old, "old").unionByName(side(new, "new")), key)


def _classify(rows: DataFrame, key: str) -> DataFrame:
    is_old, is_new = F.col("_side") == "old", F.col("_side") == "new"
    # Bag comparison with a fixed-size state: counts and sums of the fingerprint halves.
    high = F.conv(F.substring("_fp", 1, 15), 16, 10).cast("decimal(38,0)")
    low = F.conv(F.substring("_fp", 16, 15), 16, 10).cast("decimal(38,0)")

    def bag(flag: Column) -> list[Column]:
        return [F.count_if(flag), F.sum(F.when(flag, high)), F.sum(F.when(flag, low))]

    sums = [c.alias(f"_{i}") for i, c in enumerate([*bag(is_old), *bag(is_new)])]
    compared = rows.groupBy(key).agg(*sums)
    same = F.col("_0") == F.col("_3")
    for a, b in (("_1", "_4"), ("_2", "_5")):
        same = same & F.col(a).eqNullSafe(F.col(b))
    change = (
        F.when(F.col("_0") == 0, "insert")
        .when(F.col("_3") == 0, "delete")
        .when(~same, "update")
    )
    return compared.select(key, change.alias("change")).filter(F.col("change").isNotNull())


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    if not has_files(spark, path):
        return None
    return spark.read.option("basePath", path).parquet(path)


def current_rows(spark: SparkSession, path: str, key: str, before: int | None = None) -> DataFrame | None:
    """Live rows of the index, None when nothing was written yet."""
    log = _versions(spark, path)
    if log is None:
        return None
    if before is not None:
        log = log.filter(F.col("version") < before)
    newest = first_row(log, key, [F.desc("version")])
    return newest.filter(F.col("_op") == UPSERT)


def current_index(spark: SparkSession, path: str, key: str) -> DenseIndex:
    rows = current_rows(spark, path, key)
    if rows is None:
        raise ValueError(f"no index at {path}")
    return DenseIndex(rows.drop("_op", "_fp", "version"), key, "embedding")


def refresh_index(
    docs: DataFrame,
    path: str,
    key: str,
    text_col: str,
    embedder: Embedder,
    version: int,
    deletes: bool = True,
) -> DataFrame:
    """Write version `version` of the index at `path` and return its changes (key, _op).

    `docs` is a full snapshot with unique keys, or with `deletes=False` a set of new and
    changed rows. A rerun of the same version overwrites it and compares with the versions
    before it, so retries are harmless.
    """
    spark = docs.sparkSession
    new = docs.withColumn("_fp", fingerprint(docs.columns))
    old = current_rows(spark, path, key, before=version)
    changed = new
    if old is not None:
        # Keys and fingerprints are compared, not texts: a row is new or changed when its
        # fingerprint is not in the index under its key. Only those rows are then picked.
        fresh = new.select(key, "_fp").join(old.select(key, "_fp"), [key, "_fp"], "left_anti")
        changed = keep_keys(new, fresh, key)
    log = embed(changed, text_col, embedder).withColumn("_op", F.lit(UPSERT))
    if deletes and old is not None:
        gone = old.select(key).join(docs.select(key), key, "left_anti")
        log = log.unionByName(gone.withColumn("_op", F.lit(DELETE)), allowMissingColumns=True)
    target = f"{path.rstrip('/')}/version={version}"
    log.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).select(key, "_op")


def compact_index(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Write the live rows as version 0 of a fresh index folder."""
    rows = current_rows(spark, path, key)
    rows.drop("version").write.mode("errorifexists").parquet(f"{target.rstrip('/')}/version=0")


def refresh_on_arrival(
    stream: DataFrame,
    refresh: Callable[[DataFrame, int], object],
    checkpoint: str,
    interval: str = "1 hour",
    available_now: bool = False,
):
    """Run `refresh(batch, batch_id)` for new documents, at most one `interval` late."""
    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
