"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``PREFIX`` nearest pivots in order. The index is a table with
one row per block of at most ``BLOCK_ROWS`` vectors: their ids and components, and one
inverted file per pivot that posts which vectors of the block hold it, and at which place.
A query accumulates the footrule distance (sum of the differences of place, a missing pivot
standing one place behind the last) over the files of its own pivots, reranks the rows of
least footrule of every block by Euclidean distance and keeps the nearest.

The pivots are a bounded sample, all rows are indexed. Of every block ``RERANK`` rows are
reranked, or more: the share of its rows that ``SAMPLE`` further rows, searched by brute force
and by footrule, need for ``RECALL`` of their neighbours. Rows that tie
with the last one reranked are reranked too, so copies of one vector need no cut. Recall is
measured against brute force in the tests.

Queries are a stated set; they meet all blocks in batches of ``QUERY_BATCH`` that are broadcast,
one pass over the index for each batch. Every task keeps only the nearest few of each query.

Vectors that are null, empty or zero, or hold a null or non-finite component take no part, nor do
rows without id. A shorter vector counts as filled up with zeros. Rows of equal id are one
another's own row: none is the other's neighbour; a repeated row counts once. Equal distances
go to the smaller id. With fewer candidates than asked for, all are returned; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import ready, stage

K = 10
PIVOTS = 256
PREFIX = 128
BLOCK_ROWS = 4096
BLOCK_VALUES = 1 << 22  # components in a block, where vectors are very long
RERANK = 512
SAMPLE = 64
RECALL = 0.97
QUERY_BATCH = 8192
BLOCK = "ids array<long>, dim int, vectors binary, starts array<int>, rows binary, places binary"


def usable(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Columns id and v (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False)))
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(whole & F.exists(v, lambda x: x != 0), F.lit(False)))


def _matrix(lists: pa.Array, dim: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(lists.value_lengths())
    wide = max(dim, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == wide).all():
        return values.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide))
    out[np.arange(wide) < sizes[:, None]] = values
    return out


def _widened(rows: np.ndarray, dim: int) -> np.ndarray:
    return rows if rows.shape[1] >= dim else np.pad(rows, ((0, 0), (0, dim - rows.shape[1])))


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, the squares added up in order of the components."""
    if not rows.shape[1]:
        return np.zeros(len(rows))
    return np.sqrt(np.add.accumulate((rows - query) ** 2, axis=1)[:, -1])


def prefixes(rows: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Each row's nearest pivots in order, ties to the pivot listed first."""
    dim = max(rows.shape[1], pivots.shape[1])
    rows, pivots = _widened(rows, dim), _widened(pivots, dim)
    far = (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :length]


class Files:
    """A block's vectors and its inverted files by pivot."""

    def __init__(self, ids, vectors, starts, rows, places, prefix: int):
        self.ids, self.vectors, self.starts, self.rows, self.places = ids, vectors, starts, rows, places
        self.prefix = prefix

    @classmethod
    def post(cls, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> Files:
        near = prefixes(vectors, pivots, prefix)
        held = near.ravel()
        order = np.argsort(held, kind="stable")
        starts = np.searchsorted(held[order], np.arange(len(pivots) + 1))
        rows, places = np.divmod(order, near.shape[1])
        return cls(ids, vectors, starts, rows.astype(np.uint16), places.astype(np.uint16), near.shape[1])

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Footrule distance of every row of the block to a query's prefix."""
        m = self.prefix
        # as if no pivot were shared, then each shared one put right
        apart = np.full(len(self.ids), m * (m + 1), np.int64)
        for place, pivot in enumerate(query.tolist()):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            there = self.places[a:b].astype(np.int64)
            apart[self.rows[a:b]] += np.abs(there - place) - (m - there) - (m - place)
        return apart


def _pivots(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pivots, and further rows to set the share by: those of least hash, different vectors each."""
    picked = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(4 * (PIVOTS + SAMPLE)).toArrow()
    if not picked.num_rows:
        return np.zeros((0, 0)), np.zeros((0, 0))
    matrix = _matrix(picked.column("v").combine_chunks())
    _, first = np.unique(matrix, axis=0, return_index=True)
    matrix = matrix[np.sort(first)]
    return matrix[:PIVOTS], matrix[PIVOTS : PIVOTS + SAMPLE]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to blocks of bounded rows and components."""
    held: list[pa.RecordBatch] = []
    rows = values = 0
    for batch in batches:
        sizes = np.cumsum(np.asarray(batch.column("v").value_lengths()))
        start = 0
        while start < batch.num_rows:
            done = int(sizes[start - 1]) if start else 0
            fits = int(np.searchsorted(sizes, done + BLOCK_VALUES - values, side="right"))
            stop = min(batch.num_rows, start + BLOCK_ROWS - rows, fits)
            if stop <= start and not held:
                stop = start + 1
            if stop > start:
                held.append(batch.slice(start, stop - start))
                rows, values = rows + stop - start, values + int(sizes[stop - 1]) - done
                start = stop
            if start < batch.num_rows or rows >= BLOCK_ROWS:
                yield pa.concat_batches(held)
                held, rows, values = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def build(rows: DataFrame, pivots: np.ndarray, dtype: str = "f8") -> DataFrame:
    """The index over rows (id, v): one row per block. ``dtype`` f4 stores vectors that came as floats."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    prefix = min(PREFIX, len(pivots))

    def run(batches):
        for group in _groups(batches):
            vectors = _matrix(group.column("v"))
            files = Files.post(group.column("id").to_numpy(), vectors, shared.value, prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([files.ids]), pa.array([vectors.shape[1]], pa.int32()),
                    pa.array([vectors.astype(dtype).tobytes()]), pa.array([files.starts.astype(np.int32)]),
                    pa.array([files.rows.tobytes()]), pa.array([files.places.tobytes()]),
                ],
                names=["ids", "dim", "vectors", "starts", "rows", "places"],
            )

    return stage(rows.mapInArrow(run, BLOCK), "permutation-index")


def _opened(batches: Iterator[pa.RecordBatch], prefix: int, dtype: str) -> Iterator[Files]:
    for batch in batches:
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"], dtype).astype(np.float64).reshape(-1, row["dim"])
            rows, places = (np.frombuffer(row[c], np.uint16) for c in ("rows", "places"))
            yield Files(np.array(row["ids"], np.int64), vectors, np.array(row["starts"]), rows, places, prefix)


def _own(vectors: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and a query of one width."""
    dim = max(vectors.shape[1], len(query))
    return _widened(vectors, dim), np.pad(query, (0, dim - len(query)))


def _share(index: DataFrame, sample: np.ndarray, pivots: np.ndarray, dtype: str, k: int) -> float:
    """Share of a block's rows to rerank: the sampled rows' true neighbours found by footrule in ``RECALL`` of all cases."""
    if not len(sample):
        return 1.0
    prefix = min(PREFIX, len(pivots))
    shared = index.sparkSession.sparkContext.broadcast((sample, prefixes(sample, pivots, prefix)))

    def run(batches):
        queries, near = shared.value
        for files in _opened(batches, prefix, dtype):
            for q, query in enumerate(queries):
                far = distances(*_own(files.vectors, query))
                found = np.flatnonzero(far > 0)
                best = found[np.lexsort((files.ids[found], far[found]))][:k]
                apart = files.footrule(near[q])
                need = np.searchsorted(np.sort(apart), apart[best], side="right") / len(apart)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), q, np.int32)), pa.array(far[best]), pa.array(files.ids[best]), pa.array(need)],
                    names=["q", "far", "id", "need"],
                )

    window = Window.partitionBy("q").orderBy("far", "id")
    found = index.mapInArrow(run, "q int, far double, id long, need double").withColumn("rank", F.row_number().over(window))
    needs = [r.need for r in found.filter(F.col("rank") <= k).select("need").collect()]  # at most SAMPLE * k numbers
    return float(np.quantile(needs, RECALL)) if needs else 1.0


def nearest(
    df: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding", key: str = "vec_id"
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the ``k`` nearest found of each row of ``queries`` among ``df``."""
    spark = df.sparkSession
    ready(spark)
    rows = usable(df, vector, key)
    pivots, sample = _pivots(rows)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(pivots):
        return spark.createDataFrame([], schema)
    dtype = "f4" if df.schema[vector].dataType.simpleString() == "array<float>" else "f8"
    index = build(rows, pivots, dtype)
    share = _share(index, sample, pivots, dtype, k)
    asked = stage(usable(queries, vector, key).distinct(), "queries")
    batches = math.ceil(asked.count() / QUERY_BATCH)
    dealt = asked.withColumn("batch", F.pmod(F.xxhash64("id", "v"), F.lit(max(batches, 1))))
    found = [_search(index, dealt.filter(F.col("batch") == b), pivots, dtype, share, k) for b in range(batches)]
    if not found:
        return spark.createDataFrame([], schema)
    union = found[0]
    for more in found[1:]:
        union = union.union(more)
    return union


def _search(index: DataFrame, queries: DataFrame, pivots: np.ndarray, dtype: str, share: float, k: int) -> DataFrame:
    """The nearest of one batch of queries, each task's and then over all tasks."""
    picked = queries.select("id", "v").toArrow()  # about QUERY_BATCH rows
    ids = picked.column("id").to_numpy()
    vectors = _matrix(picked.column("v").combine_chunks()) if len(ids) else np.zeros((0, 0))
    prefix = min(PREFIX, len(pivots))
    near = prefixes(vectors, pivots, prefix) if len(ids) else np.zeros((0, prefix), int)
    shared = index.sparkSession.sparkContext.broadcast((ids, vectors, near))

    def run(batches):
        asked, points, orders = shared.value
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(asked)
        for files in _opened(batches, prefix, dtype):
            last = min(len(files.ids), math.ceil(share * max(len(files.ids), BLOCK_ROWS))) - 1
            for q in range(len(asked)):
                apart = files.footrule(orders[q])
                # all rows as near as the last one, ties included
                rows = np.flatnonzero((apart <= np.partition(apart, last)[last]) & (files.ids != asked[q]))
                best[q] = _merged(best[q], distances(*_own(files.vectors[rows], points[q])), files.ids[rows], k)
        for q, (far, found) in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(far), q)), pa.array(np.full(len(far), asked[q])), pa.array(found), pa.array(far)],
                names=["q", "query_id", "vec_id", "score"],
            )

    window = Window.partitionBy("q").orderBy("score", "vec_id")
    return (
        index.mapInArrow(run, "q long, query_id long, vec_id long, score double").distinct()
        .withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _merged(best: tuple, far: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest of those held and some more, each row once."""
    if len(best[0]) == k:
        closer = far <= best[0][-1]
        far, ids = far[closer], ids[closer]
    far, ids = np.concatenate((best[0], far)), np.concatenate((best[1], ids))
    order = np.lexsort((ids, far))
    far, ids = far[order], ids[order]
    first = np.ones(len(far), bool)
    first[1:] = (far[1:] != far[:-1]) | (ids[1:] != ids[:-1])
    return far[first][:k], ids[first][:k]
