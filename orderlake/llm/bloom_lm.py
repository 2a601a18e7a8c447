"""Language-model scoring with n-gram counts in a log-frequency Bloom filter.

Each n-gram of the training documents is entered once for every level its count reaches,
levels being powers of two. To look a count up, levels are probed from the first until
one is missing; the last present gives the count to within a factor of two. Probabilities
are smoothed from these counts, order by order:
``p(w | c) = (count(c w) + A p'(w)) / (count(c) + A)``, with add-one unigrams below.

Counting packs the hashes of a task's n-grams by bucket, so that a bucket's counts meet
in one small group and become its own part of the filter; the number of buckets follows
the training text. The filter goes to the workers in blocks of at most ``BLOCK_BYTES``,
one pass over the documents for each; passes hand on the levels found so far.

The base score is exact. Frequent tokens, at most ``HEAD`` of them, are looked up in a
broadcast table, the rest by a join.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end per document;
null texts count as empty and hold the end alone. Rows are scored one by one, repeated or
not. Tokens are told apart by 64-bit hashes. Rows without doc_id are held out. Without
training documents every base term is log10(1/1) and the model's p is 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import blocks, ready, stage

ORDER = 2
BITS_PER_ENTRY = 10
PROBES = 5
WEIGHT = 2.0  # A above
BUCKET_TEXT = 1 << 20  # bytes of training text per bucket
BLOCK_BYTES = 128 << 20
HEAD = 500_000
_HELD = 1_500_000  # n-grams a counting task gathers before it packs them
_PIECE = 2 << 20  # bytes of text looked at together
_END = np.uint64(xxhash.xxh64_intdigest(b" "))
_STARTS = [np.uint64(xxhash.xxh64_intdigest(b" " * (n + 2))) for n in range(9)]  # contexts at a document's start, by order


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with each text's end, and where texts start, plus the end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    there = np.fromiter((bool(w) for w in words), bool, len(words))[codes]
    counted = np.concatenate(([0], np.cumsum(there)))[bounds]
    n = len(bounds) - 1
    starts = counted + np.arange(n + 1)
    out = np.empty(int(counted[-1]) + n, np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends] = _END
    out[inner] = hashes[codes[there]]
    return out, starts


def grams(flat: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, for n from 1 to ``order``; texts do not reach into each other."""
    found = [flat]
    for before in _contexts(found, starts, order):
        found.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + flat))
    return found


def _contexts(found: list[np.ndarray], starts: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For n from 2: the hash of each n-gram without its last token, from the n-grams of the order below."""
    for n in range(1, order):
        before = np.empty_like(found[n - 1])
        before[1:] = found[n - 1][:-1]
        before[starts[:-1]] = _STARTS[n]
        yield before


def level(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def decoded(levels: np.ndarray) -> np.ndarray:
    """Middle of a level's counts; 0 for level 0."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels.astype(float) - 1) - 0.5, 0.0)


def _places(hashes: np.ndarray, n: int, size: np.ndarray) -> Iterator[np.ndarray]:
    """Bit places of level n within parts of ``size`` bits."""
    a = mix(hashes + np.uint64(n * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
    low, step = a & np.uint64(0xFFFFFFFF), (a >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((((low + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * size) >> np.uint64(32)).astype(np.int64)


def build_part(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The filter's bytes for distinct hashes with their counts, and how many entries it holds."""
    levels = level(counts)
    entries = int(levels.sum())
    size = max(64, -(-entries * BITS_PER_ENTRY // 8) * 8)
    bits = np.zeros(size, bool)
    for n in range(1, int(levels.max(initial=0)) + 1):
        for place in _places(hashes[levels >= n], n, np.uint64(size)):
            bits[place] = True
    return np.packbits(bits, bitorder="little"), entries


@dataclass
class FilterBlock:
    """Some buckets' parts in a row; ``starts`` is -1 where a bucket lies in another block."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level reached by each hash; 0 where absent or in another block."""
        if not len(self.starts):
            return np.zeros(len(hashes), np.uint8)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        bucket = (distinct % np.uint64(len(self.starts))).astype(np.int64)
        found, n = np.zeros(len(distinct), np.uint8), 0
        left = np.flatnonzero(self.starts[bucket] >= 0)
        while len(left):
            n += 1
            base, size = self.starts[bucket[left]], self.sizes[bucket[left]]
            present = np.ones(len(left), bool)
            for place in _places(distinct[left], n, size):
                at = base + place
                present &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            left = left[present]
            found[left] = n
        return found[inverse]


def _train(docs: DataFrame, order: int) -> tuple[DataFrame, DataFrame, int]:
    """Exact token counts (h, c), the filter's parts (bucket, bits), the number of buckets."""
    spark = docs.sparkSession
    ready(spark)
    text = docs.select(F.col("text").cast("string").alias("text"))
    n_bytes = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(n_bytes / BUCKET_TEXT))

    def merged(parts):
        hashes, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        distinct, inverse = np.unique(hashes, return_inverse=True)
        return distinct, np.bincount(inverse, counts, len(distinct)).astype(np.int64)

    def packed(parts):
        hashes, counts = merged(parts)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        hashes, counts, bucket = hashes[by], counts[by], bucket[by]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        stops = np.append(cuts, len(bucket))[1:]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts].astype(np.int32)),
                pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary()),
                pa.array([np.minimum(counts[a:b], 0xFFFFFFFF).astype("<u4").tobytes() for a, b in zip(cuts, stops)], pa.binary()),
            ],
            names=["bucket", "hashes", "counts"],
        )

    def count(batches):
        held, size = [], 0
        for block in blocks(batches, "text", _PIECE):
            flat, starts = tokens(block.column("text"))
            # a document's start is a context too
            begins = [np.full(len(starts) - 1, s, np.uint64) for s in _STARTS[1:order]]
            for hashes in (*grams(flat, starts, order), *begins):
                held.append(np.unique(hashes, return_counts=True))
                size += len(held[-1][0])
            if size > _HELD:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)

    def build(key, group):
        listed = [
            (np.frombuffer(h, np.uint64), np.frombuffer(c, "<u4").astype(np.float64))
            for h, c in zip(group.column("hashes").to_pylist(), group.column("counts").to_pylist())
        ]
        bits, entries = build_part(*merged(listed))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary()), "entries": [entries]})

    chunks = text.mapInArrow(count, "bucket int, hashes binary, counts binary")
    parts = stage(chunks.groupBy("bucket").applyInArrow(build, "bucket int, bits binary, entries long"), "filter")
    ones = text.mapInArrow(_ones, "h long, n long")
    known = stage(ones.groupBy("h").agg(F.sum("n").alias("c")), "tokens")
    return known, parts, buckets


def _ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", _PIECE):
        hashes, counts = np.unique(tokens(block.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["h", "n"])


def _filter_blocks(parts: DataFrame, buckets: int) -> Iterator[FilterBlock]:
    total = parts.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    blocks_needed = max(1, math.ceil(total / BLOCK_BYTES))
    for k in range(blocks_needed):
        rows = parts.filter(F.col("bucket") % blocks_needed == k).select("bucket", "bits").toLocalIterator()
        held, order = [], []
        for row in rows:  # at most a block's bytes, about
            held.append(bytes(row.bits))
            order.append(row.bucket)
        lengths = np.array([len(h) for h in held], np.int64)
        starts, sizes = np.full(buckets, -1, np.int64), np.zeros(buckets, np.uint64)
        starts[order] = (np.cumsum(lengths) - lengths) * 8
        sizes[order] = (lengths * 8).astype(np.uint64)
        yield FilterBlock(np.frombuffer(b"".join(held), np.uint8), starts, sizes)


def _head(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of the most frequent tokens: all that reach a power of two few enough reach."""
    sizes = {r.p: r.n for r in known.groupBy(F.floor(F.log2("c")).alias("p")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, 64
    for p in sorted(sizes, reverse=True):
        if total + sizes[p] > HEAD:
            break
        total, least = total + sizes[p], p

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(c).to_numpy().tobytes()], pa.binary()) for c in ("h", "c")], names=["h", "c"]
            )

    rows = known.filter(F.floor(F.log2("c")) >= least).mapInArrow(pack, "h binary, c binary").collect()
    hashes = np.concatenate([np.frombuffer(r.h, np.int64).view(np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r.c, np.int64) for r in rows] or [np.zeros(0, np.int64)])
    by = np.argsort(hashes)
    return hashes[by], counts[by]


def score(docs: DataFrame, train: DataFrame, order: int = ORDER, weight: float = WEIGHT) -> DataFrame:
    """Columns doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    spark = docs.sparkSession
    known, parts, buckets = _train(train, order)
    total, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = spark.sparkContext.broadcast(_head(known))  # at most HEAD entries
    current = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    passes = list(range(max(1, math.ceil((parts.agg(F.sum(F.octet_length("bits"))).first()[0] or 0) / BLOCK_BYTES))))
    for k, block in zip(passes, _filter_blocks(parts, buckets)):
        shared = spark.sparkContext.broadcast(block)
        current = _scan(current, shared, head, k == 0, k == passes[-1], order, weight, total, distinct)
        current = stage(current, f"lm-pass-{k}")
    base = math.log10(1 / (total + distinct + 1))
    tail = (
        current.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", "t.tail", "t.times")
        .join(known, F.col("tail") == F.col("h"))
        .groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"))
    )
    return current.join(tail, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("n_tokens") * F.lit(base) + F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


def _scan(docs, shared, head, first, last, order, weight, total, distinct) -> DataFrame:
    """One pass with one filter block: doc_id, text and levels, or after the last block the scores.

    ``base`` sums log10(count + 1) over frequent tokens; tail and times list the others.
    """
    # every context of an order is an n-gram of the order below
    n_rows = 2 * order - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        hashes, counts = head.value
        for block in blocks(batches, "text", _PIECE):
            flat, starts = tokens(block.column("text"))
            found = grams(flat, starts, order)
            looked = [*found, *_contexts(found, starts, order)]
            levels = np.stack([shared.value.levels(h) for h in looked])
            if not first:
                before = [np.frombuffer(b, np.uint8).reshape(n_rows, -1) for b in block.column("levels").to_pylist()]
                levels = np.maximum(levels, np.concatenate(before, axis=1))
            if not last:
                kept = [levels[:, a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("text"), pa.array(kept, pa.binary())], names=["doc_id", "text", "levels"]
                )
                continue
            p = (decoded(levels[0]) + 1) / (total + distinct + 1)
            for n in range(1, order):
                p = (decoded(levels[n]) + weight * p) / (np.maximum(decoded(levels[order + n - 1]), decoded(levels[n])) + weight)
            scores = np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts[:-1])
            at = np.minimum(np.searchsorted(hashes, flat), max(0, len(hashes) - 1))
            frequent = hashes[at] == flat if len(hashes) else np.zeros(len(flat), bool)
            terms = np.where(frequent, np.log10(counts[at] + 1.0), 0.0) if len(hashes) else np.zeros(len(flat))
            tails, times = [], []
            rare = np.flatnonzero(~frequent)
            cuts = np.searchsorted(rare, starts)
            for a, b in zip(cuts[:-1], cuts[1:]):
                h, n = np.unique(flat[rare[a:b]], return_counts=True)
                tails.append(h.view(np.int64))
                times.append(n)
            n = len(starts) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(np.arange(row, row + n) + (part << 40)),
                    pa.array(np.diff(starts)),
                    pa.array(np.add.reduceat(frequent.astype(np.int64), starts[:-1])),
                    pa.array(np.add.reduceat(terms, starts[:-1])),
                    pa.array(scores),
                    _lists(tails, pa.int64()),
                    _lists(times, pa.int64()),
                ],
                names=["doc_id", "row", "n_tokens", "n_known", "base", "score", "tail", "times"],
            )
            row += n

    schema = (
        "doc_id long, row long, n_tokens long, n_known long, base double, score double, tail array<long>, times array<long>"
        if last
        else "doc_id long, text string, levels binary"
    )
    return docs.mapInArrow(run, schema)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64), kind))
