"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. Each is Spark's own default or
# makes a default explicit, except the forced skew-join split and the state store.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def get_session(app_name: str = "stacklore", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings above; `conf` entries override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, else a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = os.environ.get("STACKLORE_LOCAL_SCRATCH")
    if not local or not os.path.isdir(local):
        local = tempfile.mkdtemp(prefix="stacklore-")
        os.environ["STACKLORE_LOCAL_SCRATCH"] = local
    return local


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stacklore/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, inside this application's part."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote there; DataFrames built on it end with it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and is not empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(folder) and len(system.listStatus(folder)) > 0


def complete_parts(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the finished folders `<name>=<number>` below a path, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    found = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))
    return [n for n in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={n}/_SUCCESS"))]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the written table.

    Used where several plans read the same costly rows, and to cut the lineage of
    iterative joins: a lost executor re-reads files instead of recomputing rounds.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
