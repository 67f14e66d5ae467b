"""Near-duplicate texts: links of Jaccard similarity 0.75 or more between 5-word shingle sets.

Method: a set's shingles are hashed into groups and the counts per group are a point; the sum
of coordinate minima of two points bounds the intersection from above. Points are indexed in
an R-tree: leaves of LEAF near points with bounding boxes. Leaves whose boxes' bound cannot
reach the threshold are skipped, then pairs of points, and surviving pairs are verified on the
sets. Pairs already in one component need no further link.

One tree over a large corpus would not prune: every box of many texts touches every other. So
the tree's upper level is a partition into clusters that no link crosses, built exactly:
two sets with similarity 0.75 share MEET of the first |S| - ceil(0.75 |S|) + MEET shingles of
either in any common order, or all of a smaller needed overlap. The order is rarest first, by
counts of all documents' shingles in CELLS hashed cells (a table of fixed size). Sets whose sizes
allow a link are paired where they share such a shingle, and pairs that do so MEET times are
edges; where one of them meets FEW others or more at a shingle, they are chained there by size
instead, and each step is an edge. Connected edges are a cluster. One shingle is shared by chance
by ever more texts as a corpus grows, several hardly; texts that only share a common passage do
not meet, as their rare shingles come first.

Inside a cluster the points alone are compared first, and the pairs whose bound allows a link
split it into parts. A point has about a group for every three shingles and a byte for each
group: a thirtieth of its set. Sets move for the parts only, to be verified there.

Scale: one shuffle of (shingle, set) for a quarter of all shingles, one of the pairs, FEW - 1 at
most per set and shingle; points move for texts in
clusters, sets for texts in parts, once per tile. A cluster or part is sorted by size into
blocks of at most BLOCK sets, fewer where sets are large, and a tile holds two blocks, so a
huge one is many tasks, and block pairs of sizes too far apart are skipped. Tiles of one block
or two neighbouring ones come first; pairs of other blocks are made only then, and only where
the two are not in one component. A shingle whose cell counts more than HOT above the emptiest cell is
salted over many tasks; its texts are chained within each salt and the salts by one hub each. Equal sets are one class
throughout: a 64-bit hash of the set, or where unequal sets share it, found by a second such
hash, that second one.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; fewer
than five words are one shingle; a null doc_id has its component's smallest id, or null alone;
repeated rows are equal sets; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklore.llm.common import lookup_side, renamed_apart, with_row_numbers
from stacklore.llm.components import components
from stacklore.llm.shingles import Powers, mixed, shingle_set
from stacklore.session import materialise

SHARE = 75  # per cent: 100 * intersection >= SHARE * union
CELL_BITS = 22
HOT = 20_000  # rows of one shingle that may meet in one task
BLOCK = 256  # sets per block; a tile has two blocks
WIDE = 4096  # shingles beyond which a block has a quarter of the sets, and so on by fours
LEAF = 16
MEET = 4  # shingles at the front of both that a pair must share, unless it needs fewer in all
FEW = 8  # sets of fitting sizes that a shingle pairs one by one
POINT_BITS = (6, 14)  # 64 to 16,384 groups, by the size of the set
CLASS_BITS = 64
CLASS_SEEDS = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
MERGE = 32  # count tables added up by one task


def needed(size_a, size_b):
    """Smallest intersection that links sets of these sizes."""
    return -(-SHARE * (size_a + size_b) // (100 + SHARE))


def prefix_length(n: int) -> int:
    """How many of a set's first shingles hold MEET shared ones of any link, or all that it needs."""
    return min(n, n - -(-SHARE * n // 100) + MEET)


def set_hashes(s: np.ndarray, bits: int = CLASS_BITS) -> tuple[int, int]:
    """Two independent signed 64-bit hashes of a set; of the first `bits` bits."""
    sums = [np.add.reduce(mixed(s ^ seed), dtype=np.uint64) for seed in CLASS_SEEDS]
    first, second = (int(h) for h in mixed(np.array(sums, np.uint64) + np.uint64(len(s))).view(np.int64))
    return first >> (64 - bits), second


def set_class(s: np.ndarray, shared: frozenset[int] = frozenset(), bits: int = CLASS_BITS) -> int:
    """The first hash, or the second where unequal sets share the first."""
    first, second = set_hashes(s, bits)
    return second if first in shared else first


def point_bits(n: int) -> int:
    """log2 of a point's groups. Sizes that a link allows differ by one at most."""
    return min(max((n // 4).bit_length(), POINT_BITS[0]), POINT_BITS[1])


def packed_point(s: np.ndarray) -> bytes:
    """Counts of a set's shingles per group, a byte each unless one is larger."""
    groups = np.uint64((1 << point_bits(len(s))) - 1)
    counts = np.bincount((s & groups).astype(np.int64), minlength=int(groups) + 1)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def unpacked_point(packed: bytes, n: int) -> np.ndarray:
    kind = np.uint8 if len(packed) == 1 << point_bits(n) else np.uint32
    return np.frombuffer(packed, kind).astype(np.int32)


def measure(docs: DataFrame, id_column: str, text: str, bits: int = CLASS_BITS) -> DataFrame:
    """Per document (doc_id, n, cls, second, point), and per task one packed table of shingle counts.

    `cls` and `second` are the two hashes of the set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts = Powers(), np.zeros(1 << CELL_BITS, np.int32)
        for batch in batches:
            sizes, classes, points = [], [], []
            for content in batch.column(1).to_pylist():
                s = shingle_set(content, powers)
                np.add.at(counts, (s >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
                sizes.append(len(s))
                classes.append(set_hashes(s, bits) if len(s) else (None, None))
                points.append(packed_point(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *(pa.array([c[i] for c in classes], pa.int64()) for i in (0, 1)),
                 pa.array(points, pa.binary()), pa.nulls(batch.num_rows, pa.binary())],
                names=["doc_id", "n", "cls", "second", "point", "counts"],
            )
        packed = zlib.compress(counts.tobytes(), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, kind), *(pa.nulls(1, pa.int64()) for _ in range(3)), pa.nulls(1, pa.binary()),
             pa.array([packed], pa.binary())],
            names=["doc_id", "n", "cls", "second", "point", "counts"],
        )

    chosen = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(chosen.schema["doc_id"].dataType)
    name = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {name}, n long, cls long, second long, point binary, counts binary")


def with_classes(measured: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """`measured` with classes that tell sets apart, and the first hashes that unequal sets share.

    Those are two in 10^19 of all pairs of sets: some hundreds among 10^11 sets, none in
    smaller tables. Their sets take the second hash as class instead.
    """
    several = measured.filter("cls is not null").groupBy("cls").agg(
        F.min("second").alias("low"), F.max("second").alias("high")).filter("low <> high")
    shared = frozenset(r.cls for r in several.select("cls").collect())
    settled = F.when(F.col("cls").isin(*shared), F.col("second")).otherwise(F.col("cls")) if shared else F.col("cls")
    return measured.withColumn("cls", settled).drop("second"), shared


def shingle_counts(tables: DataFrame) -> np.ndarray:
    """Sum of the packed tables: MERGE at a time, until one is left for the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int32)
        for batch in batches:
            for packed in batch.column(0):
                part = np.frombuffer(zlib.decompress(packed.as_py()), np.int32)
                total = np.minimum(total.astype(np.int64) + part, np.iinfo(np.int32).max).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["counts"])

    n = tables.count()
    while n > 1:
        n = -(-n // MERGE)
        tables = materialise(tables.repartition(n).mapInArrow(add, "counts binary"), "shingle-counts")
    first = tables.first()
    return np.zeros(1 << CELL_BITS, np.int32) if first is None else np.frombuffer(zlib.decompress(first[0]), np.int32)


def first_shingles(
    docs: DataFrame, counts: np.ndarray, text: str, of_set: Callable[[np.ndarray], int] = set_class
) -> DataFrame:
    """(key, cls, n, hot_key): the rarest shingles of each set, enough of them that linked sets share MEET."""
    # What even the emptiest cell holds is other shingles that fell there: in a corpus large
    # against the table every cell's, so a cell tells of a frequent shingle by the rest.
    above = counts - counts.min()
    shared = docs.sparkSession.sparkContext.broadcast(above)  # 2**CELL_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table, row = Powers(), shared.value, 0
        for batch in batches:
            keys, classes, sizes, hot = [], [], [], []
            for content in batch.column(0).to_pylist():
                row += 1
                s = shingle_set(content, powers)
                if not len(s):
                    continue
                often = table[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                take = np.lexsort((s, often))[:prefix_length(len(s))]
                key, common = s[take], often[take] > HOT
                salts = (mixed(np.full(len(take), row, np.uint64)) % (1 + often[take].astype(np.uint64) // np.uint64(HOT)))
                keys.append(np.where(common, mixed(key + salts), key).view(np.int64))
                hot.append(np.where(common, key.view(np.int64), 0))
                classes.append(np.full(len(take), of_set(s), np.int64))
                sizes.append(np.full(len(take), len(s), np.int32))
            if not keys:
                continue
            hot_keys = np.concatenate(hot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(classes)), pa.array(np.concatenate(sizes)),
                 pa.array(hot_keys, mask=hot_keys == 0)],
                names=["key", "cls", "n", "hot_key"],
            )

    return docs.select(docs[text].alias("text")).mapInArrow(run, "key long, cls long, n int, hot_key long")


def cluster_edges(keys: DataFrame) -> DataFrame:
    """Edges (a, b) between classes that keep every possible link inside one component.

    At a key, a set is paired with each smaller one of a fitting size, if these are fewer than FEW;
    pairs that share MEET keys are edges, or as many as they need in all. A set with more of them
    (crowded) is chained to the one before it, as are the FEW - 1 before it to theirs: so all
    that fit it are connected with it by steps that are edges without a count.
    """
    order = Window.partitionBy("key").orderBy("n", "cls")
    hot = F.col("hot_key").isNotNull()
    # Most keys have one row. Rows of equal sets lie side by side, and the first one stands for them.
    several = keys.withColumn("prev", F.lag("cls").over(order)).withColumn("next", F.lead("cls").over(order)).filter(
        ~F.col("prev").eqNullSafe(F.col("cls")) & (hot | F.col("prev").isNotNull() | F.col("next").isNotNull())
    )
    crowded = F.coalesce(100 * F.lag("n", FEW).over(order) >= SHARE * F.col("n"), F.lit(False))
    before = [F.lag(F.struct("cls", "n"), i).over(order) for i in range(1, FEW)]
    placed = several.select("key", "cls", "n", "hot_key", crowded.alias("crowded"), *(x.alias(f"b{i}") for i, x in enumerate(before, 1)))
    step = F.max("crowded").over(order.rowsBetween(0, FEW - 1))
    placed = placed.withColumn("step", hot | step)

    def end(a: Column, weight: Column, hub: bool = False) -> Column:
        return F.struct(a.alias("a"), weight.cast("long").alias("weight"), F.lit(hub).alias("hub"))

    ends = []
    for i in range(1, FEW):
        size = F.col(f"b{i}.n")
        fits = 100 * size >= SHARE * F.col("n")
        # Pairs of so small sets that they need fewer than MEET count each as several.
        least = F.least(F.lit(MEET), F.ceil(SHARE * (size + F.col("n")) / (100 + SHARE)))
        weight = F.ceil(MEET / least)
        if i == 1:
            ends.append(F.when(hot & size.isNotNull() | fits, end(F.col("b1.cls"), F.when(F.col("step"), MEET).otherwise(weight))))
        else:
            ends.append(F.when(fits & ~hot & ~F.col("crowded"), end(F.col(f"b{i}.cls"), weight)))
    ends.append(F.when(hot & F.col("b1").isNull(), end(F.col("hot_key"), F.lit(MEET), True)))
    pairs = placed.select(F.col("cls").alias("b"), F.explode(F.array_compact(F.array(*ends))).alias("e")).select("e.*", "b")
    kept = materialise(
        pairs.groupBy("hub", "a", "b").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= MEET).drop("weight"),
        "join-chains",
    )
    hubs = kept.filter("hub").select(F.col("a").alias("hub_of"), F.col("b").alias("cls"))
    smallest = hubs.groupBy("hub_of").agg(F.min("cls").alias("a"))
    across = materialise(hubs.join(smallest, "hub_of").select("a", F.col("cls").alias("b")), "join-hubs")
    return kept.filter("not hub").select("a", "b").unionByName(across)


def blocks_of(members: DataFrame) -> DataFrame:
    """(cluster, n, cls, block) for (cluster, n, cls): blocks of few enough sets, by size."""
    numbered, _ = with_row_numbers(members, ["cluster", "n", "cls"], "join-members", "_row")
    # A block's sets halve twice for each step of size; steps are apart in their numbers.
    step = F.lit(0)
    for i in range(BLOCK.bit_length() // 2):
        step = step + (F.col("n") > WIDE * 4**i).cast("int")
    numbered = numbered.withColumn("_step", step.cast("long"))
    within = F.floor(F.col("_row") * F.pow(F.lit(4), F.col("_step")) / BLOCK).cast("long")
    return materialise(
        numbered.withColumn("block", F.col("_step") * (1 << 56) + within).drop("_row", "_step"), "join-blocks"
    )


def block_spans(placed: DataFrame) -> DataFrame:
    """(cluster, block, low, high, at): the sizes in a block and its place in its cluster."""
    spans = placed.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    order = Window.partitionBy("cluster").orderBy("block")
    return materialise(spans.withColumn("at", F.row_number().over(order)), "join-spans")


def near_tiles(spans: DataFrame) -> DataFrame:
    """(cluster, ti, tj) of neighbouring blocks whose sizes allow links."""
    order = Window.partitionBy("cluster").orderBy("at")
    beside = spans.withColumn("tj", F.lead("block").over(order)).withColumn("next_low", F.lead("low").over(order))
    return beside.filter(100 * F.col("high") >= SHARE * F.col("next_low")).select("cluster", F.col("block").alias("ti"), "tj")


def sent_to(placed: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, n, cluster, block, ti, tj): each set once per tile of two blocks it takes part in."""
    ends = pairs.select("cluster", F.explode(F.array("ti", "tj")).alias("block"), "ti", "tj")
    return placed.join(ends, ["cluster", "block"]).select("cls", "n", "cluster", "block", "ti", "tj")


def open_tiles(spans: DataFrame, placed: DataFrame, roots: DataFrame) -> DataFrame:
    """(cluster, ti, tj) of blocks apart whose sizes allow links and that are not in one component
    of `roots` (v, root).

    Only blocks of several components meet all others of their cluster; blocks of one component
    meet those of other ones. A cluster of copies, whose blocks are one component by now, gives
    no pairs, however many blocks it has.
    """
    rooted = placed.join(lookup_side(roots, "join-so-far"), F.col("cls") == F.col("v"), "left")
    ends = rooted.withColumn("root", F.coalesce("root", "cls")).groupBy("cluster", "block").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    known = spans.join(ends, ["cluster", "block"]).withColumn("root", F.when(F.col("r0") == F.col("r1"), F.col("r0")))
    known = materialise(known.drop("r0", "r1"), "join-known")
    other = known.select("cluster", *(F.col(c).alias(f"to_{c}") for c in ("block", "low", "high", "at", "root")))
    split = lookup_side(known.filter("root is null"), "join-split")
    pairs = split.join(other, "cluster").filter((F.col("to_at") > F.col("at")) | F.col("to_root").isNotNull())
    whole = known.filter("root is not null")
    groups = whole.select("cluster", "root").distinct()
    apart = groups.join(groups.withColumnRenamed("root", "to_root"), "cluster").filter("root <> to_root")
    across = apart.join(whole, ["cluster", "root"]).join(other, ["cluster", "to_root"]).filter("to_at > at")
    pairs = pairs.unionByName(across).filter(F.abs(F.col("to_at") - F.col("at")) > 1)
    below = F.col("at") < F.col("to_at")
    high, low = F.when(below, F.col("high")).otherwise(F.col("to_high")), F.when(below, F.col("to_low")).otherwise(F.col("low"))
    return pairs.filter(100 * high >= SHARE * low).select(
        "cluster", F.least("block", "to_block").alias("ti"), F.greatest("block", "to_block").alias("tj")
    )


def tiled_components(members: DataFrame, links_of, label: str) -> DataFrame:
    """(v, root) of the classes that `links_of` links inside the clusters of (cluster, n, cls).

    `links_of` takes rows (cls, n, cluster, block, ti, tj) and gives (a, b) for each tile.
    """
    placed = blocks_of(members)
    spans = block_spans(placed)
    own = placed.select("cls", "n", "cluster", "block", F.col("block").alias("ti"), F.col("block").alias("tj"))
    found = materialise(links_of(own.unionByName(sent_to(placed, near_tiles(spans)))), f"{label}-links")
    roots = materialise(components(found, label), f"{label}-roots")
    if spans.filter("at > 2").isEmpty():
        return roots
    still = materialise(open_tiles(spans, placed, roots), f"{label}-open")
    if still.isEmpty():
        return roots
    rest = materialise(links_of(sent_to(placed, still)), f"{label}-more")
    joined = roots.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(rest)
    return materialise(components(joined, label), f"{label}-roots")


class Leaves:
    """The R-tree's leaves over one block's points: sort-tile order, boxes per leaf."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        half = points.shape[1] // 2
        slab = np.argsort(sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[slab] = np.arange(len(sizes)) // (4 * LEAF)
        lead = points[:, :half].sum(axis=1) / np.maximum(sizes, 1)
        self.order = np.lexsort((lead, rank))
        self.points, self.sizes = points[self.order], sizes[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.starts = starts
        self.high = np.maximum.reduceat(self.points, starts, axis=0)
        self.small = np.minimum.reduceat(self.sizes, starts)
        self.large = np.maximum.reduceat(self.sizes, starts)

    def leaf(self, i: int) -> slice:
        return slice(self.starts[i], self.starts[i] + LEAF)


def group_points(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Counts of each set's shingles in 2**bits groups."""
    mask = np.uint64((1 << bits) - 1)
    return np.array([np.bincount((s & mask).astype(np.int64), minlength=1 << bits) for s in sets], np.int32)


def candidate_pairs(a: Leaves, b: Leaves, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (indices into a and b) whose points allow the needed overlap, leaf pair by leaf pair."""
    for i in range(len(a.starts)):
        box = np.minimum(a.high[i][None, :], b.high).sum(axis=1)
        floor = needed(a.small[i], b.small)
        fits = (box >= floor) & (100 * a.large[i] >= SHARE * b.small) & (100 * b.large >= SHARE * a.small[i])
        for j in np.flatnonzero(fits):
            if same and j < i:
                continue
            p, q = a.points[a.leaf(i)], b.points[b.leaf(j)]
            bound = np.minimum(p[:, None, :], q[None, :, :]).sum(axis=2)
            sizes = a.sizes[a.leaf(i)][:, None], b.sizes[b.leaf(j)][None, :]
            x, y = np.nonzero(bound >= needed(*sizes))
            x, y = a.order[x + a.starts[i]], b.order[y + b.starts[j]]
            if same:
                keep = x < y if i != j else x != y
                keep = np.ones(len(x), bool) if i != j else keep
                x, y = x[keep], y[keep]
            yield x, y


def tile_candidates(
    points: list[np.ndarray], sizes: np.ndarray, cluster: np.ndarray, left: np.ndarray, cross: bool
) -> list[tuple[int, int]]:
    """Pairs of a tile whose points allow a link, enough to join their components."""
    parent, links = np.arange(len(points)), []
    bits = np.array([len(p).bit_length() - 1 for p in points])
    for c in np.unique(cluster):
        inside = np.flatnonzero(cluster == c)
        for level in np.unique(bits[inside]):
            trees = {}
            for name, at, half in (("own", level, False), ("above", level + 1, True)):
                for side in (True, False) if cross else (True,):
                    rows = inside[(bits[inside] == at) & ((left[inside] == side) | (not cross))]
                    if len(rows):
                        whole = np.array([points[i] for i in rows])
                        folded = whole.reshape(len(rows), 2, -1).sum(axis=1) if half else whole
                        trees[name, side] = rows, Leaves(folded, sizes[rows])
            if cross:
                pairs = [(("own", True), ("own", False)), (("own", True), ("above", False)), (("above", True), ("own", False))]
            else:
                pairs = [(("own", True), ("own", True)), (("own", True), ("above", True))]
            for a, b in pairs:
                if a not in trees or b not in trees:
                    continue
                (rows_a, tree_a), (rows_b, tree_b) = trees[a], trees[b]
                for x, y in candidate_pairs(tree_a, tree_b, a == b):
                    x, y = rows_a[x], rows_b[y]
                    apart = parent[x] != parent[y]
                    for p, q in zip(x[apart], y[apart], strict=True):
                        if parent[p] != parent[q]:
                            links.append((int(p), int(q)))
                            parent[parent == parent[q]] = parent[p]
    return links


def tile_links(sets: list[np.ndarray], cluster: np.ndarray, left: np.ndarray, cross: bool) -> list[tuple[int, int]]:
    """Verified links that join components of a tile; `left` marks its first block."""
    parent = np.arange(len(sets))
    links = []
    for c in np.unique(cluster):
        inside = np.flatnonzero(cluster == c)
        sides = (inside[left[inside]], inside[~left[inside]]) if cross else (inside, inside)
        if not len(sides[0]) or not len(sides[1]) or len(inside) < 2:
            continue
        typical = int(np.median([len(sets[i]) for i in inside]))
        bits = int(np.clip(max(1, typical // 2).bit_length(), *POINT_BITS))
        trees = []
        for side in sides if cross else sides[:1]:
            chosen = [sets[i] for i in side]
            trees.append(Leaves(group_points(chosen, bits), np.array([len(s) for s in chosen], np.int64)))
        for x, y in candidate_pairs(trees[0], trees[-1], not cross):
            x, y = sides[0][x], sides[1][y]
            for p, q in zip(x, y, strict=True):
                if parent[p] == parent[q]:
                    continue
                common = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                if common >= needed(len(sets[p]), len(sets[q])):
                    links.append((int(p), int(q)))
                    parent[parent == parent[q]] = parent[p]
    return links


def _offsets(chunk: pa.Array) -> list[int]:
    """Where each value of a binary array starts in its buffer."""
    width = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
    return np.frombuffer(chunk.buffers()[1], width)[chunk.offset:chunk.offset + len(chunk) + 1].tolist()


def _numbers(table: pa.Table, ends: list[tuple[int, int]], classes: np.ndarray) -> pa.Table:
    pairs = np.array(ends, np.int64).reshape(-1, 2)
    return pa.table(
        {"a": classes[pairs[:, 0]], "b": classes[pairs[:, 1]]}, pa.schema([("a", pa.int64()), ("b", pa.int64())])
    )


def _once(table: pa.Table) -> pa.Table:
    """One row per class: an id may have come with several texts."""
    _, first = np.unique(table.column("cls").to_numpy(), return_index=True)
    return table if len(first) == table.num_rows else table.take(pa.array(first))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Each row's cluster, whether it is of the tile's first block, and whether the tile has two."""
    block, ti = table.column("block").to_numpy(), table.column("ti").to_numpy()
    return table.column("cluster").to_numpy(), block == ti, bool(ti[0] != table.column("tj").to_numpy()[0])


def point_links(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """(a, b): pairs of classes whose points (cls, point) allow a link, enough to join their components."""

    def compare(table: pa.Table) -> pa.Table:
        table = _once(table)
        sizes = table.column("n").to_numpy()
        members = [unpacked_point(p, n) for p, n in zip(table.column("point").to_pylist(), sizes.tolist(), strict=True)]
        return _numbers(table, tile_candidates(members, sizes, *_sides(table)), table.column("cls").to_numpy())

    rows = points.join(lookup_side(tiles, "join-tiles"), "cls")
    return rows.groupBy("ti", "tj").applyInArrow(compare, "a long, b long")


def chosen_sets(
    docs: DataFrame, members: DataFrame, repeated: DataFrame, text: str, id_column: str, of_set: Callable[[np.ndarray], int]
) -> DataFrame:
    """(cls, shingles) once for each class of `members`, from a row with its id.

    Ids of several rows (`repeated`) may have other classes' texts and many rows of one; only
    their sets are shuffled to leave one.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = [shingle_set(t, powers) for t in batch.column(1).to_pylist()]
            held = pa.array([len(s) > 0 for s in found], pa.bool_())
            found = [s for s in found if len(s)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(held), pa.array([of_set(s) for s in found], pa.int64()),
                 pa.array([s.tobytes() for s in found], pa.binary())],
                names=["doc_id", "cls", "shingles"],
            )

    kind = docs.schema[id_column].dataType.simpleString()

    def of(ids: DataFrame, label: str) -> DataFrame:
        rows = docs.join(lookup_side(ids, label), docs[id_column].eqNullSafe(F.col("_id")), "left_semi")
        return rows.select(docs[id_column].alias("doc_id"), docs[text].alias("text")).mapInArrow(
            sets, f"doc_id {kind}, cls long, shingles binary"
        )

    ids = members.select(F.col("doc_id").alias("_id")).distinct()
    same = F.col("_id").eqNullSafe(F.col("_again"))
    again = repeated.select(F.col("_id").alias("_again"))
    found = of(ids.join(again, same, "left_anti"), "join-ids").select("cls", "shingles")
    several = materialise(ids.join(again, same, "left_semi"), "join-several-ids")
    if several.isEmpty():
        return found
    wanted = members.select(F.col("cls").alias("_cls"), F.col("doc_id").alias("_id"))
    theirs = of(several, "join-ids-again").join(
        wanted, (F.col("cls") == F.col("_cls")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    return found.unionByName(theirs.select("cls", "shingles").dropDuplicates(["cls"]))


def verified_links(
    docs: DataFrame, members: DataFrame, repeated: DataFrame, tiles: DataFrame, text: str, id_column: str,
    of_set: Callable[[np.ndarray], int],
) -> DataFrame:
    """(a, b): links between classes, enough to join their components."""
    side = lookup_side(tiles, "join-tiles")
    tiled = members.join(side.select("cls").distinct(), "cls", "left_semi")

    def compare(table: pa.Table) -> pa.Table:
        table = _once(table)
        sets_here = [
            np.frombuffer(chunk.buffers()[2], np.uint64, (o[i + 1] - o[i]) // 8, o[i])
            for chunk in table.column("shingles").chunks for o in [_offsets(chunk)] for i in range(len(chunk))
        ]
        return _numbers(table, tile_links(sets_here, *_sides(table)), table.column("cls").to_numpy())

    rows = chosen_sets(docs, tiled, repeated, text, id_column, of_set).join(side, "cls")
    return rows.groupBy("ti", "tj").applyInArrow(compare, "a long, b long")


def near_parts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = CLASS_BITS
) -> tuple[DataFrame, Callable[[np.ndarray], int]]:
    """(doc_id, n, cls, part) per row of `docs`, written, and how a set gives its cls; cls and part
    are null without shingles. Fewer `bits` of the first hash make more sets take the second.
    """
    docs = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    id_column, text = "doc_id", "text"
    measured, shared = with_classes(materialise(measure(docs, id_column, text, bits), "join-measured"))
    of_set = partial(set_class, shared=shared, bits=bits)
    counts = shingle_counts(measured.filter("counts is not null").select("counts"))
    rows = measured.filter("counts is null").select("doc_id", "n", "cls")
    clusters = materialise(components(cluster_edges(first_shingles(docs, counts, text, of_set)), "join-clusters"), "join-roots")
    inside = rows.filter("cls is not null").join(lookup_side(clusters, "join-roots"), F.col("cls") == F.col("v"))
    members = materialise(
        inside.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("root").alias("cluster")),
        "join-classes",
    )
    repeated = rows.filter("cls is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = materialise(repeated.select(F.col("doc_id").alias("_id")), "join-repeated-ids")
    chosen = lookup_side(members.select("cls", F.col("doc_id").alias("_id")), "join-chosen")
    points = measured.filter("cls is not null").select("doc_id", "cls", "point").join(chosen, "cls").filter(
        F.col("doc_id").eqNullSafe(F.col("_id"))
    ).select("cls", "point")
    if not repeated.isEmpty():
        points = points.dropDuplicates(["cls"])
    parts = tiled_components(
        members.select("cluster", "n", "cls"), lambda tiles: point_links(points, tiles), "join-parts"
    ).withColumnRenamed("root", "part")
    closer = members.drop("cluster").join(lookup_side(parts, "join-part"), F.col("cls") == F.col("v")).select(
        F.col("part").alias("cluster"), "n", "cls"
    )
    linked = tiled_components(
        closer, lambda tiles: verified_links(docs, members, repeated, tiles, text, id_column, of_set), "join-linked"
    ).withColumnsRenamed({"v": "_v", "root": "_root"})
    rooted = rows.join(lookup_side(linked, "join-linked"), F.col("cls") == F.col("_v"), "left").select(
        "doc_id", "n", "cls", F.coalesce("_root", "cls").alias("part")
    )
    return materialise(rooted, "join-result-parts"), of_set


def near_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = CLASS_BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs`."""
    rooted, _ = near_parts(docs, id_column, text, bits)
    several = rooted.filter("part is not null").groupBy("part").agg(
        F.min("doc_id").alias("_smallest"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1").select(F.col("part").alias("_part"), "_smallest")
    joined = rooted.join(lookup_side(several, "join-several"), F.col("part") == F.col("_part"), "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_smallest", "doc_id").alias("component_id")
    )


def with_class(docs: DataFrame, text: str, of_set: Callable[[np.ndarray], int]) -> DataFrame:
    """`docs` with the class of each row's set as last column, null without shingles."""
    at, names = docs.columns.index(text), [*docs.columns, "_class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = [shingle_set(t, powers) for t in batch.column(at).to_pylist()]
            classes = pa.array([of_set(s) if len(s) else None for s in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, classes], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_class", T.LongType())]))


def one_per_component(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = CLASS_BITS
) -> DataFrame:
    """One row of each component, with all columns of `docs`: of its rows with the smallest id
    (a null one is larger than any other) one of the smallest class.

    An id may have several texts; each goes or stays by its own component. Texts without
    shingles stay, of rows repeated with one id and such a text one; all of them without an id.
    """
    columns = docs.columns
    docs, (id_column, text) = renamed_apart(docs, id_column, text)
    rows, of_set = near_parts(docs, id_column, text, bits)
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "cls")
    several = rows.filter("part is not null").groupBy("part").agg(
        F.min(rank).alias("_first"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1").select(F.col("part").alias("_part"), "_first")
    stays = F.col("_first").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("cls") == F.col("_first.cls"))
    )
    judged = materialise(
        rows.join(lookup_side(several, "join-several"), F.col("part") == F.col("_part"), "left").select(
            "doc_id", "cls", stays.alias("stays")
        ),
        "join-result",
    )
    ids = materialise(
        judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("stays").alias("some")), "join-result-ids"
    )
    # Ids of one row are settled by the id, ids none of whose rows stay as well.
    settled = ids.filter("n > 1 or not some").select(F.col("doc_id").alias("_id"))
    single = docs.join(lookup_side(settled, "join-dropped"), docs[id_column].eqNullSafe(F.col("_id")), "left_anti")
    mixed_ids = materialise(ids.filter("n > 1 and some").select(F.col("doc_id").alias("_id")), "join-repeated")
    if mixed_ids.isEmpty():
        return single.toDF(*columns)
    theirs = docs.join(lookup_side(mixed_ids, "join-mixed"), docs[id_column].eqNullSafe(F.col("_id")), "left_semi")
    keys = judged.filter("stays").join(mixed_ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("cls").alias("_cls")).distinct()
    found = with_class(theirs, text, of_set)
    kept = found.join(
        lookup_side(keys, "join-kept"),
        found[id_column].eqNullSafe(F.col("_id")) & F.col("_class").eqNullSafe(F.col("_cls")), "left_semi",
    )
    plain = F.when(F.col("_class").isNull(), F.coalesce(found[text], F.lit("")))
    free = F.col(id_column).isNull() & F.col("_class").isNull()
    own = kept.filter(~free).withColumn("_plain", plain).dropDuplicates([id_column, "_class", "_plain"])
    found = single.unionByName(own.drop("_class", "_plain")).unionByName(kept.filter(free).drop("_class"))
    return found.toDF(*columns)
