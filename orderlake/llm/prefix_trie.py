"""Prefix trie of conversations in balanced parentheses.

A node is a distinct sequence of first turns (role, text); the conversations that start with it
are its members. Conversations are range-partitioned by (digests of their turns, conv_id), so a
shard holds a contiguous part of the trie in order, however many conversations share a turn or
are equal. A shard writes its part as balanced parentheses with a tree of least excesses over
blocks: ``close`` delimits a subtree, the rank of leaf pairs counts its leaves, a cumulative array
over the nodes in order gives its savings.

Only nodes on the paths of a shard's first and last conversation, its spines, can be in other
shards as well. Their partial values are merged by node, and summed along the merged spines by
doubling the distance to the ancestor, so the rounds are the logarithm of the depth and nothing
passes through one task. Ids of the conversations that end at a spine node are written as sorted
runs and digested as a stream.

Turns are taken by turn number (nulls first), then digest; null role or text is empty; repeated
rows are turns each. Rows without conv_id are left out. A conversation's turns are held as 24 bytes
each in one row, their texts never. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import ready, stage

BLOCK = 256
WORD = 16  # bytes of a turn's digest
SHARD_TURNS = 20_000
NODE = (
    "shard int, spine boolean, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string, ends string, first_end long"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses with the excess after each, and least excesses over blocks and pairs of blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int64)
        blocks = max(1, math.ceil(len(opens) / BLOCK))
        self.width = 1 << (blocks - 1).bit_length()
        padded = np.full(self.width * BLOCK, len(opens) + 1, np.int64)
        padded[: len(opens)] = self.excess
        levels = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(axis=1))
        self.least = np.concatenate([np.zeros(1, np.int64), *levels[::-1]])  # a heap: node k has 2k and 2k + 1
        pair = np.zeros(len(opens) + 1, np.int64)
        pair[1:-1] = opens[:-1] & ~opens[1:]
        self.pairs = np.cumsum(pair)  # leaf pairs that begin before a place
        self.opened = np.concatenate([[0], np.cumsum(opens)])

    def close(self, at: int) -> int:
        """The place of the parenthesis that closes the one opened at ``at``."""
        if not self.opens[at + 1]:
            return at + 1
        target = self.excess[at] - 1
        block = at // BLOCK
        end = min((block + 1) * BLOCK, len(self.opens))
        found = np.flatnonzero(self.excess[at + 1 : end] == target)
        if len(found):
            return at + 1 + int(found[0])
        k = block + self.width
        while k & 1 or self.least[k + 1] > target:  # up until a later sibling dips low enough
            k >>= 1
        k += 1
        while k < self.width:  # down to its first such block
            k = 2 * k if self.least[2 * k] <= target else 2 * k + 1
        start = (k - self.width) * BLOCK
        return start + int(np.flatnonzero(self.excess[start : start + BLOCK] == target)[0])

    def leaves(self, at: int, close: int) -> int:
        return int(self.pairs[close] - self.pairs[at])

    def nodes(self, at: int, close: int) -> int:
        return int(self.opened[close] - self.opened[at])


def paths(df: DataFrame) -> DataFrame:
    """Columns conv_id, path (the digests of its turns joined) and sizes (code points of their texts)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).alias("size"),
    )
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn")).filter("conv_id is not null")
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return turns.select(
        "conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.size").alias("sizes")
    )


def shared_openings(convs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c with its first turns, crc32(c) % ``most`` of them, replaced by those of c - c % ``group``."""
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h})
    opening = convs.select(
        F.col("conv_id").alias("base"), F.substring("path", 1, (most - 1) * WORD).alias("base_path"),
        F.slice("sizes", 1, most - 1).alias("base_sizes"),
    )
    joined = own.join(opening, "base", "left")
    return joined.select(
        "conv_id",
        F.concat(
            F.coalesce(F.expr(f"substring(base_path, 1, h * {WORD})"), F.lit(b"")), F.expr(f"substring(path, h * {WORD} + 1)")
        ).alias("path"),
        F.concat(
            F.coalesce(F.expr("slice(base_sizes, 1, h)"), F.array().cast("array<int>")),
            F.expr("slice(sizes, h + 1, greatest(size(sizes) - h, 0))"),
        ).alias("sizes"),
    )


def trie(convs: DataFrame) -> DataFrame:
    """All nodes of conversations (conv_id, path, sizes); the columns of ``RESULT``."""
    ready(convs.sparkSession)
    convs = stage(convs, "trie-paths")
    turns = convs.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(1, math.ceil(turns / SHARD_TURNS))
    ordered = convs.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = stage(ordered.mapInArrow(_shard, NODE), "trie-nodes")
    inner, spines = nodes.filter(~F.col("spine")), nodes.filter("spine")
    merged = stage(_merge(spines), "trie-spines")
    # a shard's own spine nodes with their merged smallest member, to be parents of its inner nodes
    known = spines.select("shard", "node").join(merged.select("node", F.col("conv_id").alias("least")), "node")
    below = inner.filter("parent is not null").drop("parent_conv_id").join(
        known.withColumnRenamed("node", "parent"), ["shard", "parent"]
    ).withColumnRenamed("least", "parent_conv_id")
    return merged.select(RESULT).union(inner.filter("parent is null").select(RESULT)).union(below.select(RESULT))


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One contiguous part of the trie as rows of its nodes; those inside hold final values."""
    opens, depth, least, size, count, names = [], [], [], [], [], []
    ends: dict[int, list[int]] = {}
    stack: list[int] = []
    path = first_path = None

    def enter(conv_id: int, length: int, prefix: bytes) -> None:
        stack.append(len(least))
        opens.append(True)
        depth.append(len(stack) - 1)
        least.append(conv_id)
        size.append(length)
        count.append(0)
        names.append(hashlib.blake2b(prefix, digest_size=WORD, salt=b"trie").digest())

    for batch in batches:
        for conv_id, new, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes"))):
            if path is None:
                first_path = new
                enter(conv_id, 0, b"")
            elif new != path:
                shared = _common(path, new)
                while len(stack) > shared + 1:
                    stack.pop()
                    opens.append(False)
            path = new
            for place in range(len(stack) - 1, len(sizes)):
                parent = names[stack[-1]]
                enter(conv_id, sizes[place], parent + new[place * WORD : (place + 1) * WORD])
            for node in stack:
                count[node] += 1
                least[node] = min(least[node], conv_id)
            ends.setdefault(stack[-1], []).append(conv_id)
    if path is None:
        return
    opens += [False] * len(stack)
    yield from _rows(np.array(opens), depth, least, size, count, names, ends, len(first_path) // WORD, set(stack))


def _common(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    words = min(len(a), len(b)) // WORD
    differ = np.flatnonzero(
        (np.frombuffer(a, np.uint64, words * 2) != np.frombuffer(b, np.uint64, words * 2)).reshape(-1, 2).any(axis=1)
    )
    return int(differ[0]) if len(differ) else words


def _rows(opens, depth, least, size, count, names, ends, first_depth: int, last_spine: set[int]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    bits = Parentheses(opens)
    places = np.flatnonzero(opens)
    n = len(places)
    counts, sizes = np.array(count, np.int64), np.array(size, np.int64)
    savings = np.concatenate([[0], np.cumsum((counts - 1) * sizes)])
    # the first path is a run of opening parentheses; the last one is open at the end
    spine = [k <= first_depth or k in last_spine for k in range(n)]
    parents: list[int] = [-1] * n
    held: list[int] = []
    for k in range(n):
        del held[depth[k] :]
        parents[k] = held[-1] if held else -1
        held.append(k)
    children, spine_leaves, spine_saved = [0] * n, [0] * n, [0] * n
    leaves, saved = [0] * n, [0] * n
    for k in range(n):
        at = int(places[k])
        if spine[k]:
            continue
        close = bits.close(at)
        leaves[k], saved[k] = bits.leaves(at, close), int(savings[k + bits.nodes(at, close)] - savings[k])
        children[parents[k]] += 1
        if spine[parents[k]]:  # what hangs off the spine, whole
            spine_leaves[parents[k]] += leaves[k]
            spine_saved[parents[k]] += saved[k]
    columns = {f: [] for f in ("spine", "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                               "n_leaves", "saved_tokens", "size", "ends_sha256", "ends", "first_end")}
    for k in range(n):
        joined = ",".join(map(str, ends.get(k, ())))
        above = parents[k]
        row = (
            spine[k], names[k] if spine[k] else None, names[above] if above >= 0 and spine[above] else None, least[k], depth[k],
            None if spine[k] or spine[above] else least[above], count[k], children[k],
            spine_leaves[k] if spine[k] else leaves[k], spine_saved[k] if spine[k] else saved[k], size[k],
            None if spine[k] else hashlib.sha256(joined.encode()).hexdigest(),
            joined if spine[k] and k in ends else None, ends[k][0] if k in ends else None,
        )
        for values, value in zip(columns.values(), row):
            values.append(value)
    schema = pa.schema(
        [("shard", pa.int32()), ("spine", pa.bool_()), ("node", pa.binary()), ("parent", pa.binary())]
        + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")]
        + [("ends_sha256", pa.string()), ("ends", pa.string()), ("first_end", pa.int64())]
    )
    table = pa.table({"shard": pa.array([shard] * n, pa.int32()), **columns}, schema=schema)
    yield from table.to_batches(max_chunksize=4096)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined runs of ids of each node, from rows sorted by node and first id."""
    node, digest, made = None, None, []
    for batch in batches:
        for name, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if name != node:
                if node is not None:
                    made.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
    if node is not None:
        made.append((node, digest.hexdigest()))
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["node", "ends_sha256"])


def _merge(spines: DataFrame) -> DataFrame:
    """Spine nodes of all shards, one row each, with their final values."""
    runs = spines.filter("ends is not null").select("node", "ends", "first_end")
    digests = runs.repartition("node").sortWithinPartitions("node", "first_end").mapInArrow(_digests, "node binary, ends_sha256 string")
    nodes = spines.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("size").alias("size"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    nodes = stage(nodes, "spine-nodes")
    above = nodes.groupBy("parent").agg(F.count("*").alias("more")).withColumnRenamed("parent", "node")
    least = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    total = F.col("n_children") + F.coalesce("more", F.lit(0))
    own = nodes.join(above, "node", "left").join(least, "parent", "left").join(digests, "node", "left").select(
        "node", F.col("parent").alias("up"), "conv_id", "depth", "parent_conv_id", "n_convs", total.alias("n_children"),
        (F.col("n_leaves") + F.when(total == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
    found = stage(own, "spine-sums")
    deepest = found.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        # each node holds the sum over its descendants nearer than 2^k, and its ancestor at 2^k
        lower = found.filter("up is not null").groupBy(F.col("up").alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        higher = found.select(F.col("node").alias("up"), F.col("up").alias("next"))
        grown = found.join(lower, "node", "left").join(higher, "up", "left")
        found = stage(
            grown.select(
                "node", F.col("next").alias("up"), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"), "ends_sha256",
            ),
            "spine-sums",
        )
    return found
