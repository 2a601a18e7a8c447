"""Document fingerprints from closed syncmers, and each document's likeness to others.

A k-mer of characters is an anchor if the least of its inner s-mers, by hash, lies at
either edge. That depends on the k-mer alone, so equal passages have equal anchors
wherever they stand. A fingerprint is all distinct anchors of a text, each with the place
of its first occurrence. Two fingerprints are as alike as the share of the anchors of their
union that both have in the same order (the longest increasing run of places). What is
shown of a fingerprint is its ``ANCHORS`` anchors of least hash, then a SHA-256 digest over
all of them.

A text without any anchor has one of its whole content; an empty text (null counts as
empty) has an empty fingerprint, alike to empty ones only. Equal texts have equal
fingerprints.

"Next" is the next row in descending doc_id, after the last the first; rows of equal id
follow each other by text, rows without id come last. Rows are routed by ranges of ids
from quantiles over all rows, an id that fills several ranges by the beginnings of its
texts, and the first row that follows a range is routed to it too (of each batch the first
one that may be it), so no task sees more than its ranges. Rows of one id that begin alike
share a range, which is sorted with spilling and read in blocks.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import blocks, ready

K = 16
S = 6
ANCHORS = 32  # shown of a fingerprint, beside the digest of all
RANGE_BYTES = 8 << 20  # text routed to one range, about
MAX_RANGES = 20_000  # beyond it ranges grow: bounds of all ranges go through the driver
TASK_BYTES = 64 << 20  # text of a task, about
HEAD = 100  # characters of a text that tell the ranges of one id apart
_SAMPLED = 20  # beginnings looked at per range, to place the bounds within an id
Print = np.ndarray | list  # rows (hash, place) ascending by hash; of an empty text []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    return least


def anchors(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All closed syncmers of the texts: text number, place, hash (64 bits)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(codes) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = codes[: len(codes) - s + 1].copy()
    for j in range(1, s):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += codes[j : len(codes) - s + 1 + j]
    grams = _mix(grams)
    least = _sliding_least(grams, k - s + 1)
    n = len(least)
    closed = (grams[:n] == least) | (grams[k - s : k - s + n] == least)
    ends = np.cumsum(lengths)
    at = np.flatnonzero(closed)
    text = np.searchsorted(ends, at, side="right")
    inside = at + k <= ends[text]
    at, text = at[inside], text[inside]
    value = grams[at]
    for offset in (*range(s, k - s, s), k - s):  # the s-mers that cover the k-mer
        value = _mix(value * np.uint64(0x9E3779B97F4A7C15) + grams[at + offset])
    return text, at - (ends - lengths)[text], value


def fingerprints(texts: list[str], k: int = K, s: int = S) -> list[Print]:
    """All distinct anchors of each text."""
    text, place, value = anchors(texts, k, s)
    order = np.lexsort((place, value, text))
    text, place, value = text[order], place[order], value[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, place, value = text[first], place[first], value[first]
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    pairs = np.stack([value, place.astype(np.uint64)], axis=1)
    found: list[Print] = []
    for t, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
        if a < b:
            found.append(pairs[a:b])
        else:
            found.append(np.array([[xxhash.xxh64_intdigest(t.encode()), 0]], np.uint64) if t else [])
    return found


def shown(print_: Print, size: int = ANCHORS) -> str:
    if not len(print_):
        return ""
    least = "".join(f"{h:016x}{p:08x}" for h, p in print_[:size].tolist())
    return least + hashlib.sha256(print_.astype("<u8").tobytes()).hexdigest()


def _run(places: np.ndarray) -> int:
    """Length of the longest increasing run, of places that all differ."""
    if (places[1:] > places[:-1]).all():
        return len(places)
    run: list[int] = []
    for place in places.tolist():
        if not run or place > run[-1]:
            run.append(place)
        else:
            run[bisect_left(run, place)] = place
    return len(run)


def likeness(one: Print, other: Print) -> float:
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    _, left, right = np.intersect1d(one[:, 0], other[:, 0], assume_unique=True, return_indices=True)
    order = np.argsort(one[left, 1])
    return _run(other[right, 1][order]) / (len(one) + len(other) - len(left))


def edited(text: str, following: str) -> str:
    """Text with its second half replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Ranges:
    """Bounds (id, beginning of text) of ranges in the order of rows: ids descending, then texts.

    A range starts at its bound; what precedes all bounds is range 0.
    """

    def __init__(self, ids: list[int], heads: dict[int, list[str]]):
        """``ids``: ranges start at the first row of each; ``heads``: and within these ids."""
        self.heads = {i: [b"", *sorted({h.encode() for h in found if h})] for i, found in heads.items()}
        self.ids = np.sort(np.array([i for i in set(ids) for _ in self.heads.get(i, [b""])], np.int64))
        self.split = np.array(sorted(self.heads), np.int64)

    def place(self, ids: np.ndarray, heads: pa.Array) -> np.ndarray:
        part = len(self.ids) - np.searchsorted(self.ids, ids, side="left")
        for i in np.flatnonzero(np.isin(ids, self.split)).tolist():
            listed = self.heads[int(ids[i])]
            part[i] += bisect_right(listed, heads[i].as_py().encode()) - len(listed)
        return part


def _ranges(rows: DataFrame, parts: int) -> Ranges:
    shares = [k / parts for k in range(1, parts)]
    found = (rows.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] if shares else None) or []
    often = {i: n for i, n in Counter(found).items() if n > 1}
    heads: dict[int, list[str]] = {i: [] for i in often}
    if often:
        share = min(1.0, _SAMPLED * parts / rows.count())
        within = rows.filter(F.col("id").isin(list(often))).sample(share, seed=1).select("id", F.substring("text", 1, HEAD).alias("head"))
        sampled = defaultdict(list)
        for r in within.collect():  # some 20 beginnings per range
            sampled[r.id].append(r.head)
        for i, listed in sampled.items():
            listed.sort(key=str.encode)
            heads[i] = [listed[len(listed) * k // often[i]] for k in range(1, often[i])]
    return Ranges(found, heads)


def _followers(rows: DataFrame, ranges: Ranges) -> dict[tuple[int, str], list[int]]:
    """(id, beginning) of the first row of each range, with the ranges that it follows."""

    def place(batches):
        for batch in batches:
            part = ranges.place(batch.column("id").to_numpy(), batch.column("head"))
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], names=["part", "id", "head"])

    placed = rows.select("id", _head(ranges)).mapInArrow(place, "part long, id long, head string")
    first = placed.groupBy("part").agg(F.min(F.struct(F.bitwise_not("id").alias("id"), "head")).alias("first"))
    listed = sorted((r.part, ~r.first.id, r.first.head) for r in first.collect())  # one row per range
    found: dict[tuple[int, str], list[int]] = {}
    for (part, *_), (_, *key) in zip(listed, [*listed[1:], *listed[:1]]):
        found.setdefault(tuple(key), []).append(part)
    return found


def _head(ranges: Ranges) -> Column:
    """Texts are read for their beginnings only where an id is split."""
    return (F.substring("text", 1, HEAD) if len(ranges.split) else F.lit("")).alias("head")


def compare(docs: DataFrame, k: int = K, s: int = S, size: int = ANCHORS) -> DataFrame:
    """Columns doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next, one row per document.

    ``edited`` is the SHA-256 digest of the edited text in hex.
    """
    spark = docs.sparkSession
    ready(spark)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = _ranges(rows, min(MAX_RANGES, max(1, math.ceil(n_bytes / RANGE_BYTES))))
    followers = _followers(rows, ranges)
    tops = np.array(sorted({i for i, _ in followers}), np.int64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, heads, batch = batch.column("id").to_numpy(), batch.column("head"), batch.drop_columns(["head"])
            yield _routed(batch, ranges.place(ids, heads), 0)
            least: dict[tuple[int, str], tuple[bytes, int]] = {}
            for i in np.flatnonzero(np.isin(ids, tops)).tolist():
                key = (int(ids[i]), heads[i].as_py())
                if key in followers:
                    least[key] = min(least.get(key, (b"\xff", i)), (batch.column("text")[i].as_py().encode(), i))
            pairs = [(i, part) for key, (_, i) in least.items() for part in followers[key]]
            if pairs:
                chosen = batch.take(pa.array([i for i, _ in pairs]))
                yield _routed(chosen, np.array([part for _, part in pairs]), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for block in blocks(batches):
            if held is not None:
                block = pa.concat_batches([held, block])
            # the last row may be followed by one of the next block
            held = block.slice(block.num_rows - 1)
            yield from _compared(block, k, s, size)

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / TASK_BYTES))
    routed = rows.select("*", _head(ranges)).mapInArrow(route, "part long, guest int, doc_id long, id long, text string")
    ordered = routed.repartition(tasks, F.col("part")).sortWithinPartitions("part", "guest", F.desc("id"), "text")
    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _routed(batch: pa.RecordBatch, part: np.ndarray, guest: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part), pa.array(np.full(len(part), guest, np.int32)), *batch.columns], names=["part", "guest", "doc_id", "id", "text"]
    )


def _compared(block: pa.RecordBatch, k: int, s: int, size: int) -> Iterator[pa.RecordBatch]:
    """Every row of a range's own with the row after it; a range ends with a guest."""
    own = np.flatnonzero(block.column("guest").to_numpy()[:-1] == 0)
    if not len(own):
        return
    texts = block.column("text").to_pylist()
    prints = fingerprints(texts, k, s)
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    other = fingerprints(changed, k, s)
    yield pa.RecordBatch.from_arrays(
        [
            block.column("doc_id").take(pa.array(own)),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([shown(prints[i], size) for i in own]),
            pa.array([shown(p, size) for p in other]),
            pa.array([likeness(prints[i], p) for i, p in zip(own, other)]),
            pa.array([likeness(prints[i], prints[i + 1]) for i in own]),
        ],
        names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
