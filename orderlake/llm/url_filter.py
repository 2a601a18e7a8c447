"""URL filters over a sorted digest array.

Rules (host, path, verdict) are kept as 64-bit xxhash keys of host + path, sorted, beside
the strings themselves. The array lies in files that workers map into memory, not read
into it. A URL asks for all of its host's suffixes with as many labels as any rule has,
each with all starts of its path as long as any rule's path; keys are found by binary
search over whole batches, and the stored string must be equal, which settles collisions.
The longest rule wins, between equally long ones that of the longer host. Where no rule
fits, the verdict is ``default``.

A host runs from the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path from there to ``?``, ``#`` or the end. A null URL, or one without
``://``, has neither. Repeated rules count once, the first verdict by name holding.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.llm.common import new_folder, ready, unused

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    start = -1 if url is None else url.find("://")
    if start < 0:
        return "", ""
    rest = url[start + 3 :]
    ends = [i for i in map(rest.find, "?#") if i >= 0]
    rest = rest[: min(ends)] if ends else rest
    slash = rest.find("/")
    slash = len(rest) if slash < 0 else slash
    return rest[:slash].translate(_LOWER), rest[slash:]


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")


@dataclass(frozen=True)
class Index:
    """Where the shards lie, the least key of each, and the shapes rules have."""

    folder: str
    shards: tuple[int, ...]
    least: tuple[int, ...]
    labels: tuple[int, ...]
    path_lengths: tuple[int, ...]


class Shard:
    """One mapped file: n, then n keys, n + 1 string ends, n host lengths, n verdicts, the strings."""

    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        n = int(mapped[:8].view("<u8")[0])
        at = 8
        self.keys, at = mapped[at : at + 8 * n].view("<u8"), at + 8 * n
        self.ends, at = mapped[at : at + 8 * n + 8].view("<u8"), at + 8 * n + 8
        self.hosts, at = mapped[at : at + 8 * n].view("<u8"), at + 8 * n
        self.blocked, at = mapped[at : at + n], at + n
        self.strings = mapped[at:]

    def string(self, i: int) -> bytes:
        return self.strings[int(self.ends[i]) : int(self.ends[i + 1])].tobytes()

    @staticmethod
    def pack(keys: np.ndarray, strings: list[bytes], hosts: list[int], blocked: list[bool]) -> bytes:
        ends = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        arrays = [np.array([len(keys)]), keys, ends, np.array(hosts)]
        return b"".join([*(a.astype("<u8").tobytes() for a in arrays), np.array(blocked, np.uint8).tobytes(), *strings])


def build(spark: SparkSession, rules: DataFrame, shards: int = 1) -> Index:
    """Write the digest array of rules (host, path, verdict) to a new folder in the shared place."""
    ready(spark)
    folder = new_folder(spark, "url-rules")
    system, root = _system(folder)
    system.create_dir(root)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(h or "", p or "") for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            keys = np.array([xxhash.xxh64_intdigest((h + p).encode()) for h, p in pairs], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys ^ np.uint64(1 << 63)).view(np.int64)),  # signed order is key order
                    pa.array([h for h, _ in pairs], pa.string()), pa.array([p for _, p in pairs], pa.string()), batch.column("verdict"),
                ],
                names=["key", "host", "path", "verdict"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # a shard's rules
        if not sum(p.num_rows for p in parts):
            return
        held = pa.Table.from_batches(parts).to_pydict()
        keys = np.array(held["key"], np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        strings = [(h + p).encode() for h, p in zip(held["host"], held["path"])]
        data = Shard.pack(keys, strings, [len(h.encode()) for h in held["host"]], [v == "block" for v in held["verdict"]])
        shard, (system, root) = TaskContext.get().partitionId(), _system(folder)
        with system.open_output_stream(f"{root}/.{shard}-{os.getpid()}") as out:
            out.write(data)
        system.move(f"{root}/.{shard}-{os.getpid()}", f"{root}/{shard}.rules")
        shapes = sorted({(h.count(".") + 1, len(p)) for h, p in zip(held["host"], held["path"])})
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([held["key"][0]], pa.int64()),
                pa.array([[a for a, _ in shapes]], pa.list_(pa.int32())), pa.array([[b for _, b in shapes]], pa.list_(pa.int32())),
            ],
            names=["shard", "least", "labels", "lengths"],
        )

    rows = rules.select(*[F.col(c).cast("string") for c in ("host", "path", "verdict")])
    once = rows.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    keyed = once.mapInArrow(digest, "key long, host string, path string, verdict string")
    sorted_ = keyed.repartitionByRange(shards, "key").sortWithinPartitions("key", "host")
    found = sorted(sorted_.mapInArrow(write, "shard int, least long, labels array<int>, lengths array<int>").collect())
    return Index(
        folder,
        tuple(r.shard for r in found),
        tuple(r.least + (1 << 63) for r in found),
        tuple(sorted({x for r in found for x in r.labels})),
        tuple(sorted({x for r in found for x in r.lengths})),
    )


class Matcher:
    """The index as one worker maps it."""

    def __init__(self, index: Index):
        self.index = index
        system, root = _system(index.folder)
        self.shards = [Shard(self._mappable(system, f"{root}/{s}.rules")) for s in index.shards]

    @staticmethod
    def _mappable(system: fs.FileSystem, path: str) -> str:
        """The file itself, or a local copy of one that lies in a remote store."""
        if isinstance(system, fs.LocalFileSystem):
            return path
        with system.open_input_stream(path) as source, tempfile.NamedTemporaryFile(delete=False) as target:
            while part := source.read(1 << 20):
                target.write(part)
        return target.name

    def asked(self, host: str, path: str) -> list[tuple[str, str]]:
        """Host suffixes with starts of the path that a rule could have."""
        labels = host.split(".")
        suffixes = [".".join(labels[-n:]) for n in self.index.labels if n <= len(labels)]
        return [(s, path[:n]) for s in suffixes for n in self.index.path_lengths if n <= len(path)]

    def match(self, urls: list[tuple[str, str]]) -> list[tuple[str, bool] | None]:
        """Rule string and whether it blocks, for each (host, path)."""
        asked = [(i, h, p) for i, (host, path) in enumerate(urls) for h, p in self.asked(host, path)]
        best: list[tuple[int, int, str, bool] | None] = [None] * len(urls)
        keys = np.array([xxhash.xxh64_intdigest((h + p).encode()) for _, h, p in asked], np.uint64)
        place = np.searchsorted(np.array(self.index.least, np.uint64), keys, side="right") - 1
        for number, shard in enumerate(self.shards):
            mine = np.flatnonzero(place == number)
            first = np.searchsorted(shard.keys, keys[mine], side="left")
            last = np.searchsorted(shard.keys, keys[mine], side="right")
            for at in np.flatnonzero(first < last):
                i, host, path = asked[mine[at]]
                wanted = (host + path).encode()
                for k in range(int(first[at]), int(last[at])):
                    if shard.string(k) == wanted and int(shard.hosts[k]) == len(host.encode()):
                        rule = (len(host) + len(path), len(host), host + path, bool(shard.blocked[k]))
                        best[i] = rule if best[i] is None else max(best[i], rule)
        return [b and b[2:] for b in best]


_MATCHERS: dict[Index, Matcher] = {}


def judge(pages: DataFrame, index: Index, default: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (page_id by default), host, path, rule, verdict, one row per page; a name
    that a kept column has gets ``_`` behind."""
    ready(pages.sparkSession)
    kept = pages.select(*[pages[c] for c in keep or ["page_id"]])
    (url,) = unused(kept, "_url")
    schema = StructType(list(kept.schema.fields))
    for name in unused(kept, "host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _MATCHERS.get(index) or _MATCHERS.setdefault(index, Matcher(index))
        for batch in batches:
            urls = [split_url(u) for u in batch.column(url).to_pylist()]
            found = matcher.match(urls)
            made = [
                [h for h, _ in urls], [p for _, p in urls], [f and f[0] for f in found],
                [default if f is None else "block" if f[1] else "allow" for f in found],
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names if c != url] + [pa.array(m, pa.string()) for m in made], names=schema.names
            )

    rows = pages.select(*[pages[c] for c in kept.columns], pages["url"].cast("string").alias(url))
    return rows.mapInArrow(run, schema)
