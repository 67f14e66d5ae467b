"""Prefix trie of conversations as balanced parentheses, one sequence per shard.

Every distinct sequence of turns that some conversation starts with is a node. Conversations are
sorted by their turns' digests and cut into ranges; a shard writes its part of the trie as an
opening parenthesis per node in depth-first order and its closing one after the subtree. Then

* findclose, by minima of the running excess over blocks and a tree of minima over those,
  delimits each node's subtree;
* the rank of `()` pairs between a node's two parentheses counts its leaves;
* cumulative arrays over the openings give members and savings, a range minimum the smallest
  member.

Neighbouring shards share the nodes along the common prefix of one's last and the other's first
conversation. Such spines are written as partial rows and merged by their prefix's digest: each
shared node counts its own text, and itself as a child, in its first shard only. All other rows
are final where they are made; only those below a spine look up its merged row.

A turn is the 128-bit SHA-256 prefix of its role and text from where it is read on, so texts are
never shuffled. Equal conversations are grouped before they are sorted. Their ids, of which one
group may hold any number, are cut into chunks over all tasks, in order, and each group's
hash runs over its chunks as a stream. The driver gets two numbers per shard.

A conversation is one row of 24 bytes a turn; a shard holds the nodes of SHARD_TURNS turns, or
as many as one conversation has.

Defined cases: a null role or text is empty; null turns come first; equal turn numbers follow
their digests, and rows repeated are turns of their own; rows without conv_id take no part; an
empty table gives no rows, not even the root; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.llm.common import lookup_side
from stacklore.session import materialise

SHARD_TURNS = 200_000
CHUNK_BYTES = 1 << 20
BLOCK = 64
NO_MEMBER = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

GROUP = "key binary, conv_id long, n long, ends string"
NODE = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


class Parentheses:
    """A balanced sequence with minima of its excess per block and a tree over the blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // BLOCK)
        self.leaves = 1 << max(0, int(blocks - 1).bit_length())
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.least = np.empty(2 * self.leaves, np.int64)
        self.least[self.leaves:] = padded.reshape(self.leaves, BLOCK).min(axis=1)
        for node in range(self.leaves.bit_length() - 2, -1, -1):
            level = slice(1 << node, 2 << node)
            below = self.least[2 << node:4 << node]
            self.least[level] = np.minimum(below[0::2], below[1::2])

    def _scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Look for `target` from `at` to the end of its block; gives those that are not there."""
        while len(which):
            inside = at < len(self.bits)
            hit = inside & (self.excess[np.minimum(at, len(self.bits) - 1)] == target[which])
            found[which[hit]] = at[hit]
            more = ~hit & ((at + 1) % BLOCK != 0)
            yield_to = which[~hit & ~more]
            if len(yield_to):
                self._left.append(yield_to)
            which, at = which[more], at[more] + 1
        left = np.concatenate(self._left) if self._left else np.empty(0, np.int64)
        self._left = []
        return left

    def findclose(self) -> np.ndarray:
        """The closing parenthesis of every opening one: the first later place with one less excess."""
        self._left: list[np.ndarray] = []
        target = self.excess[self.opens] - 1
        found = np.full(len(self.opens), -1)
        which = np.arange(len(self.opens))
        last_of_block = (self.opens + 1) % BLOCK == 0
        inner = which[~last_of_block]
        rest = np.concatenate([self._scan(self.opens[inner] + 1, target, found, inner), which[last_of_block]])
        if not len(rest):
            return found
        node = self.opens[rest] // BLOCK + 1 + self.leaves
        wanted = target[rest]
        while (far := self.least[node] > wanted).any():
            node = np.where(far, np.where(node & 1, (node + 1) >> 1, node + 1), node)
        while (inner := node < self.leaves).any():
            left = np.where(inner, 2 * node, node)
            node = np.where(inner & (self.least[left] > wanted), left + 1, left)
        self._scan((node - self.leaves) * BLOCK, target, found, rest)
        return found

    def leaf_pairs(self) -> np.ndarray:
        """1 where `()` starts."""
        return self.bits & ~np.append(self.bits[1:], 1).astype(self.bits.dtype) & 1


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of values[first..last], by two overlapping spans of a power of two."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    spans = values
    for power in range(int(level.max(initial=0)) + 1):
        here = level == power
        out[here] = np.minimum(spans[first[here]], spans[last[here] - (1 << power) + 1])
        if len(spans) > 1 << power:
            spans = np.minimum(spans[:-(1 << power)], spans[1 << power:])
    return out


@dataclass(frozen=True)
class Seam:
    """Turns shared by a shard's first and last conversation with its neighbours; -1 without one."""

    before: int = -1
    after: int = -1


def spine_keys(digests: list[bytes], shared: int) -> list[bytes]:
    """Digest of every prefix of up to `shared` turns."""
    state, keys = hashlib.sha256(), []
    for depth in range(shared + 1):
        keys.append(state.digest()[:16])
        if depth < shared:
            state.update(digests[depth])
    return keys


def shard_nodes(paths: list[tuple], seam: Seam) -> pa.RecordBatch:
    """Rows of one shard's trie; `paths` are sorted (digests, sizes, members, smallest, hash of ids)."""
    bits = bytearray([1])
    parent, depth, size, end = [-1], [0], [0], []
    stack, previous = [0], []
    for digests, sizes, *_ in paths:
        shared, limit = 0, min(len(previous), len(digests))
        while shared < limit and previous[shared] == digests[shared]:
            shared += 1
        bits += b"\0" * (len(previous) - shared) + b"\1" * (len(digests) - shared)
        del stack[shared + 1:]
        for d in range(shared, len(digests)):
            parent.append(stack[-1])
            depth.append(d + 1)
            size.append(sizes[d])
            stack.append(len(parent) - 1)
        end.append(stack[-1])
        previous = digests
    bits += b"\0" * (len(previous) + 1)

    tree = Parentheses(np.frombuffer(bytes(bits), np.uint8))
    nodes = len(parent)
    close = tree.findclose()
    number = np.arange(nodes)
    last = number + (close - tree.opens) // 2
    parent, depth, size = np.array(parent), np.array(depth, np.int64), np.array(size, np.int64)

    # Nodes shared with the shard before stand on the first path, those shared with the next on the last.
    old = number <= seam.before
    on_last = np.zeros(nodes, bool)
    on_last[stack] = True
    spine = old | (on_last & (depth <= seam.after))

    ends, smallest, hashes = np.zeros(nodes, np.int64), np.full(nodes, NO_MEMBER), [EMPTY_SHA] * nodes
    for node, (_, _, members, least, sha) in zip(end, paths, strict=True):
        ends[node], smallest[node], hashes[node] = members, least, sha

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[last + 1] - total[number]

    members = below(ends)
    pairs = tree.leaf_pairs().astype(np.int64)
    if seam.after == len(previous):
        pairs[tree.opens[end[-1]]] = 0  # it goes on in the next shard
    rank = np.concatenate([[0], np.cumsum(pairs)])
    fresh = ~old
    children = np.bincount(parent[fresh & (number > 0)], minlength=nodes)
    smallest = range_minima(smallest, number, last)

    keys: list[bytes | None] = [None] * nodes
    for node, key in zip(range(seam.before + 1), spine_keys(paths[0][0], max(0, seam.before)), strict=False):
        keys[node] = key
    for node, key in zip(stack[:seam.after + 1], spine_keys(previous, max(0, seam.after)), strict=False):
        keys[node] = key
    parent_keys = [keys[p] if p >= 0 else None for p in parent.tolist()]
    known = (parent >= 0) & ~spine[np.maximum(parent, 0)]
    columns = [
        pa.array(keys, pa.binary()), pa.array(parent_keys, pa.binary()), pa.array(smallest), pa.array(depth),
        pa.array(smallest[np.maximum(parent, 0)], mask=~known), pa.array(members), pa.array(children),
        pa.array(rank[close + 1] - rank[tree.opens]),
        pa.array(below(members * size) - below(np.where(fresh, size, 0))), pa.array(hashes, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NODE.split(", ")])


def turn_paths(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as digest and bytes of text."""
    who, said = F.coalesce(conversations[role], F.lit("")), F.coalesce(conversations[text], F.lit(""))
    named = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    turns = conversations.filter(conversations[conv_id].isNotNull()).select(
        conversations[conv_id].cast("long").alias("conv_id"), conversations[turn].alias("turn"),
        F.unhex(F.substring(F.sha2(named, 256), 1, 32)).alias("digest"), F.octet_length(said).cast("long").alias("bytes"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "bytes")))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t.digest.alias("digest"), t.bytes.alias("bytes"))).alias("path")
    )


def spliced(paths: DataFrame, group: int, most: int) -> DataFrame:
    """Conversation c with its first h turns taken from c - c % group, h = crc32(c) % most.

    At most `most` - 1 turns of a base conversation move, to at most `group` others.
    """
    own = materialise(paths, "trie-turns")
    kind = own.schema["path"].dataType.simpleString()
    heads = own.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    placed = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h)
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(kind))
    rest = F.slice("path", F.col("h") + 1, F.size("path"))
    return placed.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("path"))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to chunks (key, first id, ids, their text)."""
    key, ids, size = None, [], 0

    def chunk() -> pa.RecordBatch:
        row = [(key, ids[0], len(ids), ",".join(map(str, ids)))]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*row, strict=True), kinds, strict=True)], names=["key", "conv_id", "n", "ends"]
        )

    for batch in batches:
        out = []
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or size >= CHUNK_BYTES):
                out.append(chunk())
                ids, size = [], 0
            key = k
            ids.append(i)
            size += len(str(i)) + 1
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield chunk()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to (key, smallest id, ids, hash of all ids), one row per key."""
    key, first, n, state = None, None, 0, None
    names, kinds = ["key", "conv_id", "n", "ends"], [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        out: list[tuple] = []
        for k, i, m, ids in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    out.append((key, first, n, state.hexdigest()))
                key, first, n, state = k, i, 0, hashlib.sha256()
            state.update(ids.encode())
            n += m
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip((key, first, n, state.hexdigest()), kinds, strict=True)], names=names
        )


def equal_conversations(paths: DataFrame) -> DataFrame:
    """(key, conv_id, n, ends): per distinct path its smallest member, members, and hash of their ids."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = paths.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ids.mapInArrow(_chunked, GROUP)
    return chunks.repartition(parts, "key").sortWithinPartitions("key", "conv_id").mapInArrow(_hashed, GROUP)


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix of two paths."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x.digest == y.digest, F.lit(False)))
    at = F.array_position(same, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int")


def seams(placed: DataFrame) -> dict[int, Seam]:
    """How far each shard's first and last path go along with their neighbours'."""
    edges = materialise(
        placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")), "trie-edges"
    )
    shards = sorted(r[0] for r in edges.select("shard").collect())
    pairs = edges.sparkSession.createDataFrame(
        list(zip(shards, shards[1:], strict=False)), "shard int, next_shard int"
    )
    following = edges.select(F.col("shard").alias("next_shard"), F.col("first").alias("next_first"))
    shared = edges.join(pairs, "shard").join(following, "next_shard").select(
        "shard", "next_shard", _shared(F.col("last"), F.col("next_first")).alias("shared")
    )
    before, after = {}, {}
    for shard, next_shard, n in shared.collect():
        after[shard], before[next_shard] = n, n
    return {s: Seam(before.get(s, -1), after.get(s, -1)) for s in shards}


def trie(paths: DataFrame) -> DataFrame:
    """Nodes of the trie of `paths` (conv_id, path)."""
    spark = paths.sparkSession
    whole = F.array_join(F.transform("path", lambda t: F.hex(t.digest)), "")
    keyed = materialise(paths.withColumn("key", F.unhex(F.substring(F.sha2(whole, 256), 1, 32))), "trie-paths")
    turns = keyed.agg(F.sum(F.size("path"))).first()[0] or 0
    distinct = equal_conversations(keyed).join(keyed.select("conv_id", "path"), "conv_id").drop("key")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // SHARD_TURNS)
    placed = materialise(
        distinct.repartitionByRange(parts, "path").withColumn("shard", F.spark_partition_id()), "trie-shards"
    )
    seam_of = seams(placed)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            turns = batch.column(1)
            flat = turns.flatten()
            at = (np.asarray(turns.offsets) - np.asarray(turns.offsets)[0]).tolist()
            digests, sizes = flat.field(0).to_pylist(), flat.field(1).to_pylist()
            rest = [batch.column(c).to_pylist() for c in (0, 2, 3, 4)]
            for row, (part, n, least, sha) in enumerate(zip(*rest, strict=True)):
                if part != shard and held:
                    yield shard_nodes(held, seam_of[shard])
                    held = []
                shard = part
                held.append((digests[at[row]:at[row + 1]], sizes[at[row]:at[row + 1]], n, least, sha))
        if held:
            yield shard_nodes(held, seam_of[shard])

    ordered = placed.select("shard", "path", "n", "conv_id", "ends").repartition(parts, "shard").sortWithinPartitions(
        "shard", "path"
    )
    nodes = materialise(ordered.mapInArrow(build, NODE), "trie-nodes")
    return _with_merged_spines(nodes)


def _with_merged_spines(nodes: DataFrame) -> DataFrame:
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = F.max(F.when(F.col("ends_sha256") != EMPTY_SHA, F.col("ends_sha256")))
    spine = nodes.filter("key is not null").groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in counts],
        F.coalesce(ends, F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
    spine = lookup_side(spine, "trie-spine")
    columns = ["conv_id", "depth", "parent_conv_id", *counts, "ends_sha256"]
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.filter("key is null")
    below = inner.filter("parent_key is not null").drop("parent_conv_id").join(above, "parent_key")
    merged = spine.filter("parent_key is not null").join(above, "parent_key")
    root = spine.filter("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    found = inner.filter("parent_key is null").select(*columns)
    for part in (below, merged, root):
        found = found.unionAll(part.select(*columns))
    return found


def conversation_trie(
    conversations: DataFrame, group: int = 5, most: int = 9, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """Nodes of the trie of spliced conversations."""
    return trie(spliced(turn_paths(conversations, conv_id, turn, role, text), group, most))
