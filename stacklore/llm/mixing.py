"""Mix sources to target weights: floor(rate) copies of each document plus a Bernoulli copy.

DataFrame functions only. Two narrow passes find the rates; documents are never sorted, and
sources meet as one aggregated row each, so a source that holds a third of all rows is no
larger a group than any other.

Defined cases: null texts count 0 words; a null source is a source of its own and comes last;
a source without words has target 0 and rate 0; a null doc_id is hashed as the empty string;
rows repeated with one doc_id share their draws; an empty table gives an empty mix. Other
columns are carried unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklore.llm.common import lookup_side, renamed_apart, text_of, word_count
from stacklore.session import materialise

LIMIT = 3  # a target stops at this many times its source's size
WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
SEEDS = 16  # draws tried per source; four from each hash


def _draw(doc_id: Column, seed: int) -> Column:
    """Uniform number in [0, 1) from the document's id: 32 bits of an MD5."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed // 4}"))
    return F.conv(F.substring(F.md5(text), 1 + 8 * (seed % 4), 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sources: DataFrame) -> DataFrame:
    """Targets for (source, source_size), one row per source.

    Shares follow the weights; a target above LIMIT sizes stops there and the rest is shared
    anew. In the order of LIMIT * size / weight the stopped sources come first, so the level
    of the others follows from running sums: no iteration. One row per source is all that is
    ordered here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    index = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    ranked = sources.withColumn("_w", F.get(weights, index)).withColumn("_cap", LIMIT * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = ranked.select(
        "source", "source_size", "_w", "_cap",
        F.row_number().over(order).alias("_i"),
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).alias("_rest"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))).alias("_wsum"),
    )
    free = F.col("_rest").cast("double") * F.col("_w") <= F.col("_cap").cast("double") * F.col("_wsum")
    level = F.min(F.when(free, F.struct("_i", "_rest", "_wsum"))).over(everything)
    target = F.when(F.col("_i") < F.col("_level._i"), F.col("_cap").cast("double")).otherwise(
        F.col("_level._rest").cast("double") * F.col("_w") / F.col("_level._wsum")
    )
    return left.withColumn("_level", level).select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def mixing_plan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per row of `docs`.

    Each document's Bernoulli draw has the fraction of its source's rate as probability. Of
    SEEDS hash seeds a source uses the one whose total comes nearest to its target: all
    totals are sums of one pass, so that few large documents do not pull a small source off.
    """
    sized = materialise(
        docs.select(
            docs[id_column].alias("doc_id"), docs[source].cast("string").alias("source"),
            word_count(text_of(docs, text)).alias("size"),
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = lookup_side(source_targets(sources), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = _with(sized, targets).withColumn("_base", F.floor(rate)).withColumn("_fraction", rate - F.floor(rate))
    totals = rated.groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("_base")).alias("_fixed"),
        *[F.sum(F.when(_draw(F.col("doc_id"), s) < F.col("_fraction"), F.col("size")).otherwise(0)).alias(f"_s{s}")
          for s in range(SEEDS)],
    )
    misses = F.array(*[
        F.struct(F.abs(F.col("_fixed") + F.col(f"_s{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed"))
        for s in range(SEEDS)
    ])
    chosen = lookup_side(totals.select("source", F.array_min(misses)["seed"].alias("_seed")), "mix-seeds")
    drawn = F.lit(0.0)
    draws = [_draw(F.col("doc_id"), s) for s in range(SEEDS)]
    for s in range(SEEDS - 1, -1, -1):
        drawn = F.when(F.col("_seed") == s, draws[s]).otherwise(drawn)
    copies = F.col("_base") + F.when(drawn < F.col("_fraction"), 1).otherwise(0)
    return _with(rated, chosen).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def _with(df: DataFrame, per_source: DataFrame) -> DataFrame:
    side = per_source.withColumnRenamed("source", "_mix_source")
    return df.join(side, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents themselves, each as many times as the plan says, with the input's columns.

    The plan is joined back on id, size and source, one row for each such triple, so repeated
    rows multiply only by their own rate.
    """
    columns = docs.columns
    docs, (id_column, text, source) = renamed_apart(docs, id_column, text, source)
    plan = mixing_plan(docs, id_column, text, source)
    copies = plan.groupBy(
        F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size")
    ).agg(F.max("copies").alias("_mix_copies"))
    side = lookup_side(copies.filter("_mix_copies > 0"), "mix-copies")
    joined = docs.join(
        side,
        docs[id_column].eqNullSafe(F.col("_mix_id"))
        & docs[source].cast("string").eqNullSafe(F.col("_mix_source"))
        & (word_count(text_of(docs, text)) == F.col("_mix_size")),
    )
    repeated = joined.withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return repeated.select(*[docs[c] for c in docs.columns]).toDF(*columns)
