"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are cut into partitions of correlated bits. A pair within ``bits``
differing bits lies within the allotted threshold in at least one partition, if the
thresholds plus one each sum to ``bits + 1``; they are allotted by dynamic programming
on candidate counts estimated from all fingerprints. Probing enumerates the values
within a partition's threshold, joins them and verifies the distance.

A crowded bucket is not paired up. Its fingerprints are split again: the bits in which they vary
are dealt into 2 * bits + 2 parts, and each fingerprint goes to one bucket per choice of ``bits`` parts
left open, 56 for three bits; a pair within ``bits`` meets where the parts in which it differs are
open. In a bucket those near a member at its centre are linked to it, and linked fingerprints are
one from then on. What is not one with the bucket's largest linked set is compared with all in it,
or, where both are many, the bucket is split again by the bits that are left.

Null texts count as empty. Without any word the fingerprint is zero. Repeated rows
share a fingerprint; rows of equal id and different text keep their own. Ids may be
null: a component of such rows only has a null id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import blocks, ready, stage, text_key, unused
from orderlake.llm.components import components

BITS = 3
SHINGLE = 3
SEED = 42
CROWDED = 48  # home entries of a bucket beyond which it is split instead of paired; both are exact
COMPARED = 1 << 24  # comparisons in a bucket beyond which it is split again; both are exact
BUCKETS = 1 << 20  # places by text hash that tell rows surely to be kept from others
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
KEY = ["doc_id", "_h1", "_h2"]


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle]))
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())]
    values = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(values), 1 << 14):
        part = values[start : start + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Columns doc_id, _h1, _h2, fingerprint (as a signed long), one row per document."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").cast(pa.large_binary())
            found = [fingerprint(t.as_py() or b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in KEY] + [pa.array(np.array(found, np.uint64).view(np.int64))],
                names=[*KEY, "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, _h1 long, _h2 long, fingerprint long")


def _bit_counts(prints: DataFrame) -> tuple[np.ndarray, int]:
    """How often each pair of bits is set together, over all fingerprints: 64 x 64 numbers."""

    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.indices((64, 64))
            cells = [np.append(i.ravel(), 64), np.append(j.ravel(), 64), np.append(total.ravel(), n)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cells], names=["i", "j", "n"])

    rows = prints.select("fingerprint").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    counts, n = np.zeros((64, 64)), 0
    for row in rows.collect():  # at most 4,097 rows
        if row.i == 64:
            n = row.n
        else:
            counts[row.i, row.j] = row.n
    return counts, n


def correlated_groups(counts: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` groups of near equal size, each grown from its most correlated bit."""
    p = np.diag(counts) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    phi = np.abs((counts / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(phi, 0)
    left, groups = set(range(64)), []
    for k in range(parts):
        room = len(left) // (parts - k)
        group = [max(sorted(left), key=lambda b: phi[b, sorted(left)].sum())]
        left.remove(group[0])
        while len(group) < room:
            group.append(max(sorted(left), key=lambda b: phi[b, group].sum()))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _within(differ: np.ndarray, radius: int) -> np.ndarray:
    """Probability that independent bits, each differing so often, differ in at most 0..radius places."""
    chance = np.zeros(radius + 1)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.cumsum(chance)


def thresholds(costs: list[list[float]], bits: int) -> tuple[list[int], float]:
    """Least total cost of thresholds t >= -1 with sum(t + 1) = bits + 1; costs[i][t] for t >= 0, leaving out is free."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, bits + 1 - used):
                option = (total + (cost[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t + 1 not in grown or option < grown[used + t + 1]:
                    grown[used + t + 1] = option
        best = grown
    total, chosen = best[bits + 1]
    return chosen, total


def _project(values: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for k, bit in enumerate(group):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _flips(width: int, radius: int) -> np.ndarray:
    return np.array(
        [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(width), r)], np.uint64
    )


def _plan(prints: DataFrame, bits: int) -> tuple[list[list[int]], list[int]]:
    """The cheapest number of partitions with its bit groups and thresholds."""
    counts, n = _bit_counts(prints)
    if n < 2:
        return [], []
    p = np.diag(counts) / n
    differ = 2 * p * (1 - p)
    choices = {parts: correlated_groups(counts, n, parts) for parts in range(2, bits + 2)} if bits else {1: [list(range(64))]}
    order = [(parts, k, group) for parts, groups in choices.items() for k, group in enumerate(groups)]

    def values(batches):
        for batch in batches:
            found = batch.column(0).to_numpy().view(np.uint64)
            for at, (_, _, group) in enumerate(order):
                keys = _project(found, group).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), at, np.int32)), pa.array(keys)], names=["at", "key"]
                )

    pairs = {
        row.at: float(row.pairs)
        for row in prints.select("fingerprint").mapInArrow(values, "at int, key long")
        .groupBy("at", "key").count()
        # a crowded bucket is not paired up, so it costs a row count only
        .groupBy("at").agg(F.sum(F.col("count") * F.least("count", F.lit(CROWDED))).alias("pairs")).collect()
    }
    best = None
    for parts, groups in choices.items():
        costs = []
        for k, group in enumerate(groups):
            expected = n * n * _within(differ[group], bits)
            met = pairs[order.index((parts, k, group))]
            costs.append([n * len(_flips(len(group), t)) + met + expected[t] - expected[0] for t in range(bits + 1)])
        chosen, total = thresholds(costs, bits)
        if best is None or total < best[0]:
            best = (total, groups, chosen)
    return best[1], best[2]


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) whose components are those of all distinct fingerprints at most ``bits`` bits apart."""
    groups, allotted = _plan(prints, bits)
    used = [(k, g, t) for k, (g, t) in enumerate(zip(groups, allotted)) if t >= 0]

    def entries(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k, group, t in used:
                keys = _project(values, group)
                for flip in _flips(len(group), t):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(values), k, np.int32)),
                            pa.array((keys ^ flip).view(np.int64)),
                            pa.array(values.view(np.int64)),
                            pa.array(np.full(len(values), flip == 0)),
                        ],
                        names=["part", "key", "fp", "home"],
                    )

    probes = prints.select("fingerprint").mapInArrow(entries, "part int, key long, fp long, home boolean")
    buckets = probes.groupBy("part", "key").agg(
        F.count_if("home").alias("homes"), F.count("*").alias("n"), F.bit_or("fp").alias("any"), F.bit_and("fp").alias("all")
    ).filter("homes > 0 and n > 1")
    crowded = buckets.filter(F.col("homes") > CROWDED).select("part", "key", F.expr("any & ~all").alias("mask"))
    paired = probes.join(buckets.filter(F.col("homes") <= CROWDED).select("part", "key"), ["part", "key"])
    right = paired.filter("home").select("part", "key", F.col("fp").alias("b"))
    near = paired.withColumnRenamed("fp", "a").join(right, ["part", "key"]).filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    )
    return near.select("a", "b").union(_dense(probes.join(crowded, ["part", "key"]), bits))


def _open_masks(free: int, bits: int) -> list[int]:
    """The bits of ``free`` dealt into parts; for every choice of ``bits`` parts their bits."""
    places = [b for b in range(64) if free >> b & 1]
    parts = [sum(1 << b for b in places[k :: 2 * bits + 2]) for k in range(2 * bits + 2)]
    return [sum(choice) for choice in itertools.combinations(parts, bits)]


def _split(members: DataFrame, bits: int) -> DataFrame:
    """Members (id, fp, root, free) under every choice of parts left open; a bucket agrees on all other bits."""

    def run(batches):
        for batch in batches:
            values, free = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "free"))
            for mask in np.unique(free):
                rows = np.flatnonzero(free == mask)
                for choice, left in enumerate(_open_masks(int(mask), bits)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(pa.array(rows)),
                            pa.array(np.full(len(rows), choice, np.int32)),
                            pa.array((values[rows] & ~np.uint64(left)).view(np.int64)),
                            pa.array(values[rows].view(np.int64)),
                            batch.column("root").take(pa.array(rows)),
                        ],
                        names=["id", "choice", "value", "fp", "root"],
                    )

    found = members.mapInArrow(run, "id long, choice int, value long, fp long, root long")
    return found.select(F.xxhash64("id", "choice", "value").alias("id"), "fp", "root")


def _dense(members: DataFrame, bits: int) -> DataFrame:
    """Links among the members (fp, mask) of crowded buckets, as edges between fingerprints already linked."""
    empty = members.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    if not bits:
        return empty
    known = stage(members.groupBy("fp").agg(F.bit_or("mask").alias("mask")), "crowded")
    free = known.agg(F.bit_or("mask")).first()[0]
    if free is None:
        return empty
    work = known.select(F.lit(0).cast("long").alias("id"), "fp", F.col("fp").alias("root"), F.lit(free).cast("long").alias("free"))
    found = empty
    while True:  # the bits that vary in a bucket halve every time
        entries = stage(_split(work.select("id", "fp", "root", "free"), bits), "split")
        several = F.min("root") != F.max("root")
        stats = stage(
            entries.groupBy("id").agg(
                F.count("*").alias("n"), several.alias("several"), F.bit_or("fp").alias("any"), F.bit_and("fp").alias("all"),
                *[F.min_by("fp", F.xxhash64("fp", F.lit(k))).alias(f"some{k}") for k in range(3)],
            ).filter("several"),
            "split-buckets",
        )
        centred = stage(_centred(entries, stats, bits), "edges")
        # two steps toward the least centre; what is linked and not named alike yet is only compared more
        hub = centred.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("hub"))
        hubs = hub.join(hub.toDF("hub", "next"), "hub", "left").select("root", F.coalesce("next", "hub").alias("hub"))
        now = entries.join(stats.select("id"), "id").join(hubs, "root", "left").select("id", "fp", F.coalesce("hub", "root").alias("root"))
        now = stage(now, "members")
        sizes = now.groupBy("id").agg(F.mode("root", deterministic=True).alias("main"), F.count("*").alias("n"), several.alias("several"))
        now = now.join(sizes.filter("several").drop("several"), "id")
        others = now.filter(F.col("root") != F.col("main")).groupBy("id").agg((F.count("*") * F.any_value("n")).alias("work"))
        heavy = others.filter(F.col("work") > COMPARED).join(stats.select("id", F.expr("any & ~all").alias("free")), "id")
        paired = stage(_paired(now.join(heavy.select("id"), "id", "left_anti"), bits), "edges")
        found = found.union(centred.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).union(paired)
        work = stage(now.join(heavy.select("id", "free"), "id"), "split-again")
        if work.isEmpty():
            return found


def _centred(entries: DataFrame, stats: DataFrame, bits: int) -> DataFrame:
    """Edges to the member nearest the centre of a bucket from all within ``bits`` of it, itself included.

    The centre is the majority of three members picked by hash; which one it is decides how
    many are linked now, not whether they are in the end.
    """
    centre = F.expr("(some0 & some1) | (some0 & some2) | (some1 & some2)")
    members = entries.join(stats.select("id", centre.alias("centre")), "id")
    off = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre")))
    pivots = members.groupBy("id").agg(F.min(F.struct(off.alias("off"), "fp", "root")).alias("pivot"))
    near = members.join(pivots, "id").filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot.fp"))) <= bits)
    return near.select(F.col("root").alias("a"), F.col("pivot.root").alias("b")).distinct()


def _paired(now: DataFrame, bits: int) -> DataFrame:
    """Edges between roots within ``bits`` in a bucket (id, fp, root, main): all that are not of
    its main root against all that are, and against one another."""
    other = now.filter(F.col("root") != F.col("main")).select("id", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    near = now.join(other, "id").filter(
        (F.col("root") != F.col("root2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= bits)
    )
    return near.select(F.least("root", "root2").alias("a"), F.greatest("root", "root2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Columns doc_id, _h1, _h2, fingerprint, component_id and keep, one row per document.

    ``component_id`` is the least id linked; ``keep`` marks the content to stay of each
    component, that of the least id (nulls last), then of the least text hash.
    """
    prints = stage(fingerprints(docs, shingle, seed), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), *KEY)
    nodes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.min(first).alias("first")), "prints")
    roots = components(links(nodes, bits))
    rooted = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("kept"))
    found = rooted.select("fingerprint", "root").join(groups, "root").select("fingerprint", "component_id", "kept")
    keep = F.expr(" and ".join(f"kept.{c} <=> {c}" for c in KEY))
    return prints.join(found, "fingerprint").select(*KEY, "fingerprint", "component_id", keep.alias("keep"))


def deduplicate(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` with one document left of each component, columns as they were.

    Rows that go are named by their key, and rows of a repeated key are thinned out apart. Only
    rows whose hash shares one of ``BUCKETS`` places with such a key are looked at, so the texts
    of others are not shuffled; the places taken are broadcast, ``BUCKETS`` integers at most.
    """
    found = near_duplicates(docs, bits, shingle, seed)
    keys = found.groupBy(*KEY).agg(F.any_value("keep").alias("keep"), F.count("*").alias("n"))
    odd = stage(keys.filter(~F.col("keep") | (F.col("n") > 1)), "not-kept-once").toDF("_id", "_1", "_2", "_keep", "_n")
    h1, h2, rank, at = unused(docs, "_h1", "_h2", "_rank", "_place")
    taken = F.broadcast(odd.select(F.pmod("_1", F.lit(BUCKETS)).cast("int").alias(at)).distinct())
    place = F.pmod(text_key()[0], F.lit(BUCKETS)).cast("int") == F.col(at)
    clear, docs = docs.join(taken, place, "left_anti"), docs.join(taken, place, "left_semi")
    keyed = docs.withColumns(dict(zip((h1, h2), text_key())))
    on = keyed["doc_id"].cast("long").eqNullSafe(odd["_id"]) & (keyed[h1] == odd["_1"]) & (keyed[h2] == odd["_2"])
    once = keyed.join(odd, on, "left_anti").select(*docs.columns)
    repeated = keyed.join(odd.filter("_keep"), on, "left_semi")
    window = Window.partitionBy("doc_id", h1, h2).orderBy(h1)
    first = repeated.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1)
    return clear.union(once).union(first.select(*docs.columns))
