"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.session import materialise, tune

WORD = r"[^\x20\x09-\x0D]+"

# A lookup table may be broadcast up to this many bytes of counted content.
BROADCAST_BYTES = 32 << 20


# Rows per Arrow batch: texts may be long, and a batch is in memory several times over.
BATCH_ROWS = "2000"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators are written for."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def renamed_apart(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """`docs` under names that no operator uses inside, and the new names of `columns`.

    Operators that return whole rows work on these and end with `toDF(*docs.columns)`, so a
    column of any name passes through.
    """
    names = [f"column_{i}_of_input" for i in range(len(docs.columns))]
    return docs.toDF(*names), [names[docs.columns.index(c)] for c in columns]


def text_of(docs: DataFrame, column: str = "text") -> Column:
    return F.coalesce(docs[column], F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def content_bytes(value: Column, kind: T.DataType) -> Column:
    """Counted bytes of a value: strings and binaries by length, nested values by what they hold."""
    fixed = F.lit(16).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return fixed + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        for child in kind.fields:
            fixed = fixed + content_bytes(value.getField(child.name), child.dataType)
        return fixed
    if isinstance(kind, T.ArrayType):
        held = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + content_bytes(x, kind.elementType))
        return fixed + F.coalesce(held, F.lit(0))
    if isinstance(kind, T.MapType):
        keys = content_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + content_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    return fixed


def fits_broadcast(written: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a written table's counted bytes allow a broadcast."""
    size = F.lit(0).cast("long")
    for column in written.schema.fields:
        size = size + content_bytes(written[f"`{column.name}`"], column.dataType)
    total = written.agg(F.sum(size)).first()[0] or 0
    return total <= limit


def lookup_side(df: DataFrame, label: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Write a derived table once and mark it for broadcast if its counted bytes allow.

    Beyond the limit the join is a shuffled one, whose hot keys the adaptive plan splits.
    """
    written = materialise(df, label)
    return F.broadcast(written) if fits_broadcast(written, limit) else written


def with_row_numbers(df: DataFrame, order: list[str], label: str, number: str = "row_no") -> tuple[DataFrame, int]:
    """Number all rows from 0 in the total order of `order`; also give how many there are.

    One range shuffle; a row's number is its partition's offset plus its place there. Only
    one count per partition comes to the driver. Rows equal in `order` are spread over
    partitions by their place in the input, so a hot key is no single task; which of them
    gets which number is open. Empty input gives an empty table and 0.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in [*order, "_tie"]]
    ranged = (
        placed.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_tie")
    )
    written = materialise(ranged, label)
    part = F.shiftright("_place", 33)
    counts = sorted((r[0], r[1]) for r in written.groupBy(part).count().collect())
    starts, total = [], 0
    for index, n in counts:
        starts.append((int(index), total))
        total += n
    offsets = spark.createDataFrame(starts, T.StructType([
        T.StructField("_part", T.LongType()), T.StructField("_start", T.LongType())]))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        written.withColumn("_part", part.cast("long"))
        .join(F.broadcast(offsets), "_part")
        .withColumn(number, F.col("_start") + place)
        .drop("_part", "_start", "_place")
    )
    return numbered, total
