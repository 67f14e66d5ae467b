"""Incremental load: every CSV file delivered below a prefix is loaded once, then removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.session import has_files, materialise
from stacklore.sources import deliveries
from stacklore.sources.csv_drop import SOURCE_FILE, load_csv

LEDGER = "path string, length bigint, modified bigint, load int"
FILES_PER_LOAD = 10_000


def ingest_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_LOAD,
    purge_files: bool = True,
) -> DataFrame:
    """Append all deliveries not yet loaded to the parquet folder `target`; returns the rows there.

    Rows go to `target/load=<n>`; then `checkpoint/files` records the deliveries of load n,
    which commits it. A load that did not get so far is overwritten by the next run and is
    not part of the result. A file replaced while it is read is left out of the load, and only
    recorded deliveries are removed while they are still the files that were listed, so one
    that arrives meanwhile waits for the next run.
    """
    ledger = f"{checkpoint.rstrip('/')}/files"

    def recorded() -> DataFrame:
        if has_files(spark, ledger):
            return spark.read.schema(LEDGER).parquet(ledger)
        return spark.createDataFrame([], LEDGER)

    listed = materialise(deliveries.waiting(spark, path), "ingest-listed")
    stored_schema = T.StructType([*schema, T.StructField(SOURCE_FILE, T.StringType())])
    past = recorded()
    last = past.agg(F.max("load")).first()[0]
    committed = -1 if last is None else last
    # A reader needs the names of the files it is to read on the driver; contents stay away.
    fresh = sorted(tuple(r) for r in listed.join(past, deliveries.COLUMNS, "left_anti").select(*deliveries.COLUMNS).collect())
    for start in range(0, len(fresh), files_per_batch):
        part = fresh[start:start + files_per_batch]
        committed += 1
        place = f"{target.rstrip('/')}/load={committed}"

        def write(files: list[deliveries.Delivery]) -> None:
            paths = [deliveries.as_literal(f[0]) for f in files]
            rows = load_csv(spark, paths, schema) if paths else spark.createDataFrame([], stored_schema)
            rows.write.mode("overwrite").parquet(place)  # noqa: B023

        part = deliveries.read_steadily(spark, part, write)
        entries = spark.createDataFrame([(*f, committed) for f in part], LEDGER)
        entries.coalesce(1).write.mode("append").parquet(ledger)
    if purge_files:
        done = listed.join(recorded(), deliveries.COLUMNS, "left_semi").select(*deliveries.COLUMNS)
        deliveries.purge(spark, [tuple(r) for r in done.collect()])
    if committed < 0:
        return spark.createDataFrame([], stored_schema)
    stored = spark.read.option("basePath", target).parquet(target)
    return stored.filter(F.col("load") <= committed).drop("load")
