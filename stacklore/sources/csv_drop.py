"""CSV drops: write, load under the null and quoting contract, report, purge."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.functions.text import utc_timestamp
from stacklore.session import materialise
from stacklore.sources import deliveries
from stacklore.sources.deliveries import list_stage  # noqa: F401  (part of this module's interface)
from stacklore.sources.split_csv import csv_records
from stacklore.sources.tables import overwrite_table, qualified

# Fixed values of the file contract.
NULL_WORDS = ("NULL", "null", "")
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
FILE_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
# Line ends within quotes stay as they are.
PARSE_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"mode": "FAILFAST", "multiLine": "true"}
SOURCE_FILE, LOAD = "_source_file", "_load"
MANIFEST = "__loads"
ENTRY = f"{LOAD} int, path string, length bigint, modified bigint"
MAX_RECORDS_PER_FILE = 1_000_000


def run_stamp(at: datetime | None = None) -> str:
    """Minute-resolution stamp naming one run's files."""
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M")


def write_raw_csv(
    df: DataFrame,
    root: str,
    table: str,
    stamp: str | None = None,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> str:
    """Write `df` below `root/table/run=<stamp>`; a rerun in the same minute overwrites.

    Files carry a header and no index. Timestamps are written as UTC ISO text.
    """
    path = f"{root.rstrip('/')}/{table}/run={stamp or run_stamp()}"
    columns = [
        F.date_format(F.col(f.name).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in df.schema
    ]
    (
        df.select(*columns)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path)
    )
    return path


def typed(column: str, kind: T.DataType) -> Column:
    """Null words to NULL, then the declared type; text that does not fit is an error."""
    text = F.when(~F.col(column).isin(*NULL_WORDS), F.col(column))
    if isinstance(kind, T.TimestampNTZType):
        return utc_timestamp(text)
    return text.cast(kind)


def load_csv(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All `*.csv` files of `paths` under the contract, with the file each row came from as last column.

    Files are read by byte ranges. Columns bind by position, and every record is parsed whole,
    so a changed column count is an error even for a plan that needs one column only.
    """
    raw = ", ".join(f"c{i} string" for i in range(len(schema)))
    parsed = F.from_csv(F.col("record"), raw, PARSE_OPTIONS)
    rows = csv_records(spark, paths, FILE_OPTIONS).select("file", F.inline(F.array(parsed)))
    return rows.select(
        *(typed(f"c{i}", f.dataType).alias(f.name) for i, f in enumerate(schema)), F.col("file").alias(SOURCE_FILE)
    )


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All `*.csv` files below `path` as one bag of rows. Raises when there is no file."""
    return load_csv(spark, [path], schema)


@dataclass(frozen=True)
class Loaded:
    """A finished load: the raw table, rows per file, the files that were read, and the rows counted on the way."""

    table: DataFrame
    report: DataFrame
    files: list[str]
    rows: int


def load_raw(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    namespace: str,
    mode: str = "replace",
    purge_files: bool = True,
) -> Loaded:
    """Load every CSV delivery below `root/table` into `namespace.table`.

    "replace" overwrites the table with what waits; "append" adds the deliveries that are not
    in it. Rows carry the number of their load, and the manifest `table__loads` names each
    load's deliveries before its rows are stored: a delivery is in the table if a load naming
    it has rows there. So a load that a crash cut off is loaded once by the next, whichever
    step it had reached. Deliveries are deleted last, and only while they are still the files
    this load read.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    name, manifest = qualified(namespace, table), qualified(namespace, f"{table}{MANIFEST}")
    here = materialise(deliveries.waiting(spark, f"{root.rstrip('/')}/{table}"), "load-waiting")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {manifest} ({ENTRY}) USING parquet")
    entries = spark.table(manifest)
    last = entries.agg(F.max(LOAD)).first()[0]
    load = 0 if last is None else last + 1
    todo = here
    if mode == "append":
        todo = here.join(_in_table(spark, name, entries), deliveries.COLUMNS, "left_anti")
    files = sorted(tuple(r) for r in todo.select(*deliveries.COLUMNS).collect())
    if not files and mode == "replace":
        raise FileNotFoundError(f"no CSV file below {root.rstrip('/')}/{table}")
    counted: list[int] = []

    def stage(files: list[deliveries.Delivery]) -> None:
        nonlocal staged
        seen = Observation("load")
        paths = [deliveries.as_literal(f[0]) for f in files]
        rows = load_csv(spark, paths, schema) if paths else spark.createDataFrame([], _stored(schema)).drop(LOAD)
        staged = materialise(rows.withColumn(LOAD, F.lit(load)).observe(seen, F.count(F.lit(1)).alias("rows")), "load-rows")
        counted[:] = [seen.get["rows"]]

    staged = None
    files = deliveries.read_steadily(spark, files, stage)
    intent = spark.createDataFrame([(load, *f) for f in files], ENTRY)
    intent.coalesce(1).write.mode("append").format("parquet").saveAsTable(manifest)
    if mode == "replace":
        overwrite_table(staged, name)
    else:
        _append(spark, staged, name)
    if purge_files:
        # Also what an earlier load took and did not come to delete.
        old = here.join(_in_table(spark, name, spark.table(manifest)), deliveries.COLUMNS, "left_semi")
        deliveries.purge(spark, sorted({*files, *(tuple(r) for r in old.select(*deliveries.COLUMNS).collect())}))
    stored = spark.table(name)
    report = load_report(stored.filter(F.col(LOAD) == load))
    return Loaded(stored.drop(SOURCE_FILE, LOAD), report, [f[0] for f in files], counted[0])


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(SOURCE_FILE, T.StringType()), T.StructField(LOAD, T.IntegerType())])


def _in_table(spark: SparkSession, name: str, entries: DataFrame) -> DataFrame:
    """Deliveries of the manifest whose load has rows in the table."""
    if not spark.catalog.tableExists(name) or LOAD not in spark.table(name).columns:
        return entries.limit(0)
    return entries.join(spark.table(name).select(LOAD).distinct(), LOAD, "left_semi")


def _append(spark: SparkSession, rows: DataFrame, name: str) -> None:
    if spark.catalog.tableExists(name) and LOAD not in spark.table(name).columns:
        # A table declared or filled otherwise: its rows belong to no load.
        old = spark.table(name)
        kind = {f.name: f.dataType for f in rows.schema}
        missing = [F.lit(None).cast(kind[c]).alias(c) for c in rows.columns if c not in old.columns]
        overwrite_table(old.select("*", *missing).select(*rows.columns), name)
    rows.write.mode("append").format("parquet").saveAsTable(name)


def load_report(stored: DataFrame) -> DataFrame:
    """(file_name, rows_loaded); reads only the provenance column of a raw table."""
    counted = stored.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return counted.select(
        F.element_at(F.split(SOURCE_FILE, "/"), -1).alias("file_name"), "rows_loaded"
    )
