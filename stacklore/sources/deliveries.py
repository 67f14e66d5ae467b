"""Files as they were delivered: path, length and modification time.

A file delivered again under its old name is another delivery. A load lists what waits, reads
it, and looks again: what was replaced meanwhile may have been read in either form, so its rows
are left out and the new delivery waits for the next load. Only deliveries that are still the
ones a load took are ever deleted.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["path", "length", "modified"]
Delivery = tuple[str, int, int]


def list_stage(spark: SparkSession, path: str) -> DataFrame:
    """Files waiting below `path`; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """CSV deliveries below `path`."""
    return list_stage(spark, path).filter(F.col("path").endswith(".csv")).select(
        "path", "length", F.unix_millis("modificationTime").alias("modified")
    )


def as_literal(path: str) -> str:
    """The path with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _each(spark: SparkSession, files: list[Delivery], act: Callable) -> list[Delivery]:
    """`act(file system, path)` on every delivery that is still in place; gives those."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def one(file: Delivery) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(file[0])
        system = path.getFileSystem(conf)
        if not system.exists(path):
            return False
        status = system.getFileStatus(path)
        same = (status.getLen(), status.getModificationTime()) == tuple(file[1:])
        if same:
            act(system, path)
        return same

    with ThreadPoolExecutor(max_workers=32) as pool:
        return [f for f, same in zip(files, pool.map(one, files), strict=True) if same]


def unchanged(spark: SparkSession, files: list[Delivery]) -> list[Delivery]:
    return _each(spark, files, lambda system, path: None)


def purge(spark: SparkSession, files: list[Delivery]) -> list[Delivery]:
    """Delete these deliveries; a file that has changed since it was listed stays."""
    return _each(spark, files, lambda system, path: system.delete(path, False))


def read_steadily(spark: SparkSession, files: list[Delivery], write: Callable[[list[Delivery]], None]) -> list[Delivery]:
    """`write` the deliveries; again without those that were replaced meanwhile. Gives what it took."""
    while True:
        write(files)
        still = unchanged(spark, files)
        if len(still) == len(files):
            return files
        files = still
