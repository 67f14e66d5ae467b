"""Namespaces per layer, and how layers are stored: raw as tables, staging and marts as builds behind views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYERS = ("RAW", "STAGING", "MARTS")
BUILD = "__build"


def layer_schema(custom: str | None, target: str, default: str) -> str:
    """Namespace of a model: the target's own without a custom name, `_CI` suffix on target ci."""
    if custom is None:
        return default
    return f"{custom.strip()}_CI" if target == "ci" else custom.strip()


def qualified(namespace: str, table: str) -> str:
    return f"`{namespace}`.`{table}`"


def ensure_namespaces(spark: SparkSession, target: str = "dev", default: str = "default") -> list[str]:
    """Create the three layers when missing. Raw data is shared by all targets."""
    names = ["RAW", *(layer_schema(layer, target, default) for layer in LAYERS[1:])]
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    return names


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table with the declared columns when missing."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def overwrite_table(df: DataFrame, name: str) -> DataFrame:
    """Full rebuild of a table: written beside it under another name, which then takes its place.

    A rebuild that fails leaves the table as it was.
    """
    spark = df.sparkSession
    bare = name.rstrip("`")
    fresh = f"{bare}__next{name[len(bare):]}"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    df.write.format("parquet").saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    return spark.table(name)


def builds(spark: SparkSession, name: str) -> list[str]:
    """Stored builds of a published table, oldest first."""
    space, table = (part.strip("`") for part in name.split("."))
    found = spark.sql(f"SHOW TABLES IN `{space}` LIKE '{table}{BUILD}*'").collect()
    numbers = sorted(int(r.tableName.split(BUILD)[-1]) for r in found if r.tableName.split(BUILD)[-1].isdigit())
    return [qualified(space, f"{table}{BUILD}{n}") for n in numbers]


def publish(df: DataFrame, name: str, keep: int = 2) -> DataFrame:
    """Full rebuild behind a view: stored under a name of its own, then shown by replacing the view.

    The view is replaced in one catalog step, so a reader finds one whole build at any time and
    another session finds it too; a failed build is never shown. The newest `keep` builds stay,
    for readers that have started on the one before.
    """
    spark = df.sparkSession
    space, table = (part.strip("`") for part in name.split("."))
    past = builds(spark, name)
    number = 1 + (int(past[-1].strip("`").split(BUILD)[-1]) if past else 0)
    fresh = qualified(space, f"{table}{BUILD}{number}")
    df.write.format("parquet").saveAsTable(fresh)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # stored in place by an earlier release
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fresh}")
    for old in [*past, fresh][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Session view, evaluated when read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(spark: SparkSession, name: str, rows: int = 10) -> DataFrame:
    """The first rows of a table, for inspection."""
    return spark.table(name).limit(rows)


def list_indexes(spark: SparkSession, namespace: str) -> DataFrame:
    """Search indexes stored in a namespace."""
    return spark.sql(f"SHOW TABLES IN `{namespace}` LIKE '*_search'")
