"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard is a file of frames: the payload's length (unsigned 64-bit), the masked checksum
of those eight bytes, the payload, the masked checksum of the payload; all integers
little-endian, checksums CRC-32C, rotated right by 15 bits plus a constant as usual for
such files. The payload is one document's ids as unsigned 16-bit integers where the
vocabulary allows, else 32-bit. Shards follow each other in ascending doc_id order, rows
without id first, ties by text. Beside them lies an index table with shard, offset, bytes
and the number of ids before each record.

Each task writes its shard under a name of its own attempt and renames it, so a repeated
task replaces the file by an equal one. Null texts count as empty.
"""

from __future__ import annotations

import math
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm.chunks import PieceEncoder
from orderlake.llm.common import blocks, new_folder, ready

MASK = 0xA282EAD8
HEADER = struct.Struct("<QI")
SHARD_BYTES = 12 << 20  # of text in a shard, about
_LANE = 512
_ROOM = 64 << 20  # bytes of payload checked at a time, about


def _table(width: int) -> np.ndarray:
    """CRC-32C of every value of ``width`` bits, shifted through."""
    values = np.arange(1 << width, dtype=np.uint32)
    for _ in range(width):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0x82F63B78), values >> 1)
    return values


_TWO_BYTES = _table(16)


def _zeros(n: int) -> list[np.ndarray]:
    """How n zero bytes change a checksum, by each of its four bytes."""
    tables = []
    for k in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(n // 2):
            value = (value >> np.uint32(16)) ^ _TWO_BYTES[value & 0xFFFF]
        tables.append(value)
    return tables


_LANE_ZEROS = _zeros(_LANE)


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload.

    Payloads are cut into lanes of equal length, filled with leading zeros, which a
    checksum that starts at zero ignores; all lanes advance together, two bytes a step.
    The usual start value equals inverting the first four bytes, or, for shorter
    payloads, is carried in by hand.
    """
    out = np.zeros(len(payloads), np.uint32)
    long = [i for i, p in enumerate(payloads) if len(p) >= 4]
    for i in set(range(len(payloads))) - set(long):
        value = 0xFFFFFFFF
        for byte in payloads[i]:
            value ^= byte
            for _ in range(8):
                value = (value >> 1) ^ (0x82F63B78 if value & 1 else 0)
        out[i] = value ^ 0xFFFFFFFF
    start = 0
    while start < len(long):
        stop, size = start, 0
        while stop < len(long) and (size < _ROOM or stop == start):
            size += len(payloads[long[stop]])
            stop += 1
        _crc_long(payloads, long[start:stop], out)
        start = stop
    return out


def _crc_long(payloads: list[bytes], which: list[int], out: np.ndarray) -> None:
    lanes, parts = [], []
    for i in which:
        p = payloads[i]
        lanes.append(-(-len(p) // _LANE))
        parts += [bytes(-len(p) % _LANE), bytes(b ^ 0xFF for b in p[:4]), p[4:]]
    data = np.frombuffer(b"".join(parts), "<u2").reshape(-1, _LANE // 2)
    state = np.zeros(len(data), np.uint32)
    for column in np.ascontiguousarray(data.T):
        state ^= column
        state = (state >> np.uint32(16)) ^ _TWO_BYTES[state & 0xFFFF]
    one, two, three, four = (t.tolist() for t in _LANE_ZEROS)
    values, at = state.tolist(), 0
    for i, n in zip(which, lanes):
        value = 0
        for lane in values[at : at + n]:
            value = one[value & 255] ^ two[value >> 8 & 255] ^ three[value >> 16 & 255] ^ four[value >> 24] ^ lane
        at += n
        out[i] = value ^ 0xFFFFFFFF


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, bodies = crc32c(lengths).tolist(), crc32c(payloads).tolist()
    return [
        b"".join((n, struct.pack("<I", masked(h)), p, struct.pack("<I", masked(b))))
        for n, h, p, b in zip(lengths, heads, payloads, bodies)
    ]


def unframed(records: list[bytes]) -> list[bytes]:
    """Payloads of whole frames; raises where a length or checksum does not fit."""
    payloads = [r[HEADER.size : -4] for r in records]
    heads, bodies = crc32c([r[:8] for r in records]).tolist(), crc32c(payloads).tolist()
    for record, payload, head, body in zip(records, payloads, heads, bodies):
        length, seen = HEADER.unpack_from(record)
        if length != len(payload) or seen != masked(head) or struct.unpack("<I", record[-4:])[0] != masked(body):
            raise ValueError("a record is damaged")
    return payloads


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


_ENCODERS: dict[bytes, PieceEncoder] = {}


def _encoder(content: bytes) -> PieceEncoder:
    if content not in _ENCODERS:
        tokenizer = Tokenizer.from_buffer(content)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        _ENCODERS[content] = PieceEncoder(tokenizer, keep_space=False)
    return _ENCODERS[content]


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Write shards and index under ``folder``; returns the index: doc_id, shard, position,
    offset, bytes, n_tokens, start. The tokenizer must drop white space."""
    spark = docs.sparkSession
    ready(spark)
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    wide = max(end_id + 1, Tokenizer.from_buffer(content).get_vocab_size()) > 1 << 16
    shared = spark.sparkContext.broadcast(content)  # a vocabulary, of fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    count = shards
    if not count:
        size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
        count = max(1, math.ceil(size / SHARD_BYTES))
    base, path = _opened(folder)
    base.create_dir(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (system, root) = _encoder(shared.value), _opened(folder)
        shard = TaskContext.get().partitionId()
        temporary, at, position = f"{root}/.{shard:06d}-{uuid.uuid4().hex}", 0, 0
        with system.open_output_stream(temporary) as out:
            for block in blocks(batches):
                ids, bounds = encoder.encode(block.column("text"))
                ids = ids.astype("<u4" if wide else "<u2")
                end = np.array([end_id], ids.dtype).tobytes()
                made = frames([ids[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:])])
                out.write(b"".join(made))
                sizes = np.array([len(m) for m in made], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        pa.array(np.full(len(made), shard, np.int32)),
                        pa.array(np.arange(position, position + len(made))),
                        pa.array(at + np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                        pa.array(np.diff(bounds) + 1),
                    ],
                    names=["doc_id", "shard", "position", "offset", "bytes", "n_tokens"],
                )
                at, position = at + int(sizes.sum()), position + len(made)
        system.move(temporary, f"{root}/{shard:06d}.records")

    # rows of one id, or without one, spread over shards by the beginning of their text, in its order
    ordered = rows.withColumn("head", F.substring("text", 1, 100)).repartitionByRange(count, "doc_id", "head")
    ordered = ordered.drop("head").sortWithinPartitions("doc_id", "text")
    listed = ordered.mapInArrow(run, "doc_id long, shard int, position long, offset long, bytes long, n_tokens long")
    listed.write.parquet(f"{folder}/written")
    listed = spark.read.parquet(f"{folder}/written")
    totals = [(r.shard, r.n) for r in listed.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()]
    before, found = 0, []  # one row per shard
    for shard, n in totals:
        found.append((shard, before))
        before += n
    first = spark.createDataFrame(found, "shard int, before long")
    running = Window.partitionBy("shard").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    index = listed.join(F.broadcast(first), "shard").select(
        "doc_id", "shard", "position", "offset", "bytes", "n_tokens",
        (F.col("before") + F.coalesce(F.sum("n_tokens").over(running), F.lit(0))).alias("start"),
    )
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(index: DataFrame, folder: str, wide: bool = False) -> DataFrame:
    """The records an index names, in any order of rows: doc_id, start, ids (as stored, little-endian unsigned 32-bit)."""
    ready(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(folder)
        opened, name = None, None
        for batch in batches:
            records = []
            for shard, offset, size in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "bytes"))):
                if shard != name:
                    if opened:
                        opened.close()
                    opened, name = system.open_input_file(f"{root}/{shard:06d}.records"), shard
                records.append(opened.read_at(size, offset))
            ids = [np.frombuffer(p, "<u4" if wide else "<u2").astype("<u4").tobytes() for p in unframed(records)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"]
            )
        if opened:
            opened.close()

    return index.select("doc_id", "start", "shard", "offset", "bytes").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a new folder in the shared place and read the records back."""
    folder = new_folder(docs.sparkSession, "records")
    wide = max(end_id + 1, Tokenizer.from_file(tokenizer_path).get_vocab_size()) > 1 << 16
    return read(write(docs, folder, tokenizer_path, end_id), folder, wide)
