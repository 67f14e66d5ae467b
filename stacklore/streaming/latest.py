"""Latest row per key on a stream, equal to the batch form on the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.operators.dedup import first_row
from stacklore.session import complete_parts

COMPACT_EVERY = 16


def _backwards(value: Column, kind: T.DataType) -> Column:
    """A number that falls as `value` rises, for times, dates and numbers."""
    if isinstance(kind, T.TimestampType):
        return F.bitwise_not(F.unix_micros(value))
    if isinstance(kind, T.TimestampNTZType):
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.bitwise_not(F.timestamp_diff("MICROSECOND", start, value))
    if isinstance(kind, T.DateType):
        return F.bitwise_not(F.unix_date(value))
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(kind, T.NumericType):
        return -value
    raise TypeError(f"rows cannot be ordered by a {kind.simpleString()}")


def _recency(stream: DataFrame, order_by: str, tiebreak: Sequence[str]) -> Column:
    """Struct whose least value is the batch order's first row: NULL newest, then newest, then the tie-break."""
    return F.struct(
        F.col(order_by).isNotNull().alias("known"),
        _backwards(F.col(order_by), stream.schema[order_by].dataType).alias("age"),
        *(part for i, c in enumerate(tiebreak) for part in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"t{i}"))),
    )


def latest_state(stream: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Running latest row per key; ties go to the smaller tie-break, as in `latest_per_key`. State holds one row per key.

    Each micro-batch combines on the map side, so a hot key sends one row per task.
    """
    row = F.struct(*(F.col(c) for c in stream.columns))
    picked = stream.groupBy(*keys).agg(F.min_by(row, _recency(stream, order_by, tiebreak)).alias("_row"))
    return picked.select("_row.*")


def write_latest(state: DataFrame, target: str, checkpoint: str, keys: Sequence[str], compact_every: int = COMPACT_EVERY):
    """Append every batch's updated keys below `target/batch_id=<n>`; a replayed batch overwrites.

    Every `compact_every` batches the current rows are written below `target/_current`, from the
    ones written there before and the batches since, so that neither this nor a read goes through
    all updates ever made.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            rows = _since_compaction(batch.sparkSession, target, keys, batch_id)
            rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/_current/upto={batch_id}")

    return (
        state.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _since_compaction(spark: SparkSession, target: str, keys: Sequence[str], last: int | None = None) -> DataFrame:
    """Current row per key from the newest complete compaction before batch `last` and the batches after it."""
    root = target.rstrip("/")
    bases = [n for n in complete_parts(spark, f"{root}/_current", "upto") if last is None or n < last]
    batches = [n for n in complete_parts(spark, root, "batch_id") if last is None or n <= last]
    newest = max(bases, default=-1)
    parts = [f"{root}/batch_id={n}" for n in batches if n > newest]
    log = spark.read.option("basePath", root).parquet(*parts) if parts else None
    if newest >= 0:
        base = spark.read.parquet(f"{root}/_current/upto={newest}").withColumn("batch_id", F.lit(newest))
        log = base if log is None else log.unionByName(base)
    if log is None:
        raise FileNotFoundError(f"nothing was written to {target}")
    return first_row(log, list(keys), [F.desc("batch_id")]).drop("batch_id")


def read_latest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Current row per key: state only moves forward, so the last update of a key holds."""
    return _since_compaction(spark, target, keys)
