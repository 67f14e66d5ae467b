"""Exact copies by MSD radix partitioning: split by successive bytes until groups end.

The first digit of a text is (its length in bytes, its first bytes); later digits are the
next bytes, each digit eight times as wide as the one before up to a limit. Rows whose digit
no other row of the group shares are single and leave; a group whose texts are used up is a
group of copies. Equality rests on the bytes themselves, never on a digest.

Only the first pass sees every row, and it shuffles counts per digit, combined before the
shuffle. Digits shared by several rows are few and are looked up by broadcast when their
counted bytes allow, by a shuffled join otherwise, whose hot groups the adaptive plan splits.
Remaining bytes are written, level by level, for rows that still share a digit.

Defined cases: null texts equal empty ones; a null doc_id is smaller than any other; of rows
repeated with one doc_id and text exactly one is kept; an empty table gives no rows; other
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklore.llm.common import lookup_side, renamed_apart, text_of
from stacklore.session import materialise

FIRST_BYTES = 64
WIDEN = 8
WIDEST = 1 << 20


def _shared_digits(rows: DataFrame, digit: list[str], label: str) -> DataFrame:
    """Digits that several rows have, with a number for the new group."""
    shared = rows.groupBy(*digit).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return lookup_side(shared.withColumn("_group", F.monotonically_increasing_id()), label)


def copy_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_sha256, group): one row per input row; the group is null for single texts."""
    content = text_of(docs, text)
    first = docs.select(
        docs[id_column].alias("doc_id"), content.cast("binary").alias("_rest"),
    ).withColumn("_length", F.octet_length("_rest").cast("long")).withColumn(
        "_digit", F.substring("_rest", 1, FIRST_BYTES)
    )
    shared = _shared_digits(first, ["_length", "_digit"], "radix-first")
    level = materialise(
        first.join(shared, ["_length", "_digit"], "left").select(
            "doc_id", F.sha2("_rest", 256).alias("text_sha256"), "_group", "_length",
            F.when(F.col("_group").isNotNull() & (F.col("_length") > FIRST_BYTES),
                   F.expr(f"substring(_rest, {FIRST_BYTES + 1})")).alias("_rest"),
        ),
        "radix-level",
    )
    done, used, width, depth = [], FIRST_BYTES, FIRST_BYTES * WIDEN, 0
    while True:
        ended = F.col("_group").isNull() | F.col("_rest").isNull()
        closed = level.filter(ended).select(
            "doc_id", "text_sha256",
            F.when(F.col("_group").isNotNull(), F.struct(F.lit(depth).alias("level"), F.col("_group").alias("number")))
            .alias("group"),
        )
        done.append(closed)
        open_rows = level.filter(~ended)
        if open_rows.isEmpty():
            break
        cut = open_rows.withColumnRenamed("_group", "_parent").withColumn(
            "_digit", F.substring("_rest", 1, width)
        )
        shared = _shared_digits(cut, ["_parent", "_digit"], "radix-digits")
        used += width
        level = materialise(
            cut.join(shared, ["_parent", "_digit"], "left").select(
                "doc_id", "text_sha256", "_group", "_length",
                F.when(F.col("_group").isNotNull() & (F.col("_length") > used),
                       F.expr(f"substring(_rest, {width + 1})")).alias("_rest"),
            ),
            "radix-level",
        )
        width, depth = min(width * WIDEN, WIDEST), depth + 1
    grouped = done[0]
    for part in done[1:]:
        grouped = grouped.unionByName(part)
    return grouped


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row; the largest doc_id stays."""
    rows = copy_groups(docs, id_column, text)
    single = rows.filter("group is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    numbered = rows.filter("group is not null").withColumn("_row", F.monotonically_increasing_id())
    copies = materialise(numbered, "radix-copies")
    best = F.max(F.struct("doc_id", "_row"))
    groups = lookup_side(
        copies.groupBy("group").agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best")), "radix-groups"
    )
    several = copies.join(groups, "group").select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_best._row")).alias("kept"), "text_sha256",
    )
    return single.unionByName(several)


def without_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns of `docs`.

    Dropped ids are removed by an anti-join. An id that is both kept and dropped belongs to
    repeated rows or to different texts under one id; of such rows one per (id, text) that is
    kept stays.
    """
    columns = docs.columns
    docs, (id_column, text) = renamed_apart(docs, id_column, text)
    found = materialise(exact_copies(docs, id_column, text).select("doc_id", "kept", "text_sha256"), "radix-result")
    dropped = found.filter("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    both = found.filter("kept").join(dropped, F.col("doc_id").eqNullSafe(F.col("_dropped")), "left_semi")
    clean = docs.join(
        lookup_side(dropped, "radix-dropped"), docs[id_column].eqNullSafe(F.col("_dropped")), "left_anti"
    )
    wanted = lookup_side(
        both.select(F.col("doc_id").alias("_kept"), F.col("text_sha256").alias("_sha")).distinct(), "radix-kept"
    )
    again = docs.join(
        wanted,
        docs[id_column].eqNullSafe(F.col("_kept")) & (F.sha2(text_of(docs, text).cast("binary"), 256) == F.col("_sha")),
        "left_semi",
    ).dropDuplicates([id_column, text])
    return clean.unionByName(again).toDF(*columns)
