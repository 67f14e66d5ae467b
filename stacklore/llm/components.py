"""Connected components: edges are contracted per task, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stacklore.llm.common import lookup_side
from stacklore.session import materialise

LOCAL_ENDS = 200_000  # ends of edges that a task holds before it gives its stars


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges as stars (root, member), so that long paths cost fewer rounds."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        top = v
        while parent[top] != top:
            top = parent[top]
        while parent[v] != top:
            parent[v], v = top, parent[v]
        return top

    def given() -> pa.RecordBatch:
        pairs = [(root(v), v) for v in parent]
        pairs = [(a, b) for a, b in pairs if a != b]
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        if len(parent) > LOCAL_ENDS:
            yield given()
            parent.clear()
    yield given()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(v, root) for every end of an edge (a, b) of long ids; the root is the smallest member.

    A round contracts each task's edges to stars and takes the smallest root of every vertex,
    one shuffle with map-side combine. If no vertex has two roots, that is the result. Else
    members go to the smallest root of their root (large star) and a vertex's other roots to
    its smallest one (small star). After contraction a vertex comes once per task with edges,
    so no vertex gathers an unbounded group. Rounds grow with the logarithm of the longest path.

    Rounds are written to the shared folder, so that a lost executor repeats one round.
    """
    current = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b")
    while True:
        stars = materialise(current.mapInArrow(_stars, "a long, b long"), label)
        roots_too = stars.select(F.col("b").alias("v"), "a", F.lit(False).alias("is_root")).unionByName(
            stars.select(F.col("a").alias("v"), "a", F.lit(True).alias("is_root")))
        found = materialise(roots_too.groupBy("v").agg(
            F.min("a").alias("root"), F.max("a").alias("last"), F.max("is_root").alias("is_root")), f"{label}-least")
        if found.filter("root <> last").isEmpty():
            return found.select("v", "root")
        moved = found.filter("is_root and root <> v").select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        large = stars.join(lookup_side(moved, f"{label}-moved"), F.col("a") == F.col("_v"), "left").select(
            F.coalesce("_root", "a").alias("a"), "b")
        least = large.withColumn("m", F.min("a").over(Window.partitionBy("b")))
        # Written first: a task reads many small files, so contraction sees more edges at once.
        current = materialise(least.select(F.explode(F.when(F.col("a") == F.col("m"), F.array("b")).otherwise(F.array("a", "b")))
                               .alias("b"), F.col("m").alias("a")).select("a", "b").filter("a <> b"), f"{label}-edges")
