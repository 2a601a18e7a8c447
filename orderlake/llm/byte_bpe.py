"""Byte-level BPE with the tokenizers library, from a file of ranks.

A rank file gives each token's bytes. The library works on characters, so the bytes are
written in the 256 printable characters of byte-level BPE, and every pair of tokens whose
union is a token becomes a merge of the union's rank. Decoding looks up each id's bytes;
a token may hold part of a character, so text is only made from joined bytes.

Null texts count as empty: no ids, no bytes. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from orderlake.llm.chunks import PieceEncoder, binaries, byte_characters, expand
from orderlake.llm.common import blocks, ready, unused


BLOCK_BYTES = 1 << 20


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def build(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer that merges, within each match of the pattern, the pair of lowest rank first."""
    characters = byte_characters()
    shown = {token: "".join(characters[b] for b in token) for token in ranks}
    merges = [
        (shown[token[:i]], shown[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    made = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return made


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, content: bytes, pattern: str):
        ranks = read_ranks(content)
        self.encoder = PieceEncoder(build(ranks, pattern), keep_space=True)
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; the ends of a cut id sequence may hold parts of characters."""
        return self.bytes[expand(self.starts[ids], self.lengths[ids])].tobytes()

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past last character that each token has bytes of."""
        data = np.frombuffer(self.decode(ids), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return character[ends - self.lengths[ids]], character[ends - 1] + 1


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """One codec per process and vocabulary."""
    if (content, pattern) not in _CODECS:
        _CODECS[content, pattern] = Codec(content, pattern)
    return _CODECS[content, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str] | None = None, offsets: bool = False) -> DataFrame:
    """Columns ``keep`` (doc_id by default), n_tokens, ids (little-endian unsigned 32-bit) and decoded (bytes from
    the ids); with ``offsets`` also char_start and char_end of each token. A name that a kept
    column has gets ``_`` behind. ``ranks_path`` is read on the driver."""
    spark = docs.sparkSession
    ready(spark)
    kept = docs.select(*[docs[c] for c in keep or ["doc_id"]])
    (text,) = unused(kept, "_text")
    rows = docs.select(*[docs[c] for c in kept.columns], docs["text"].cast("string").alias(text))
    n_name, ids_name, decoded_name, start_name, end_name = unused(kept, "n_tokens", "ids", "decoded", "char_start", "char_end")
    schema = StructType(list(kept.schema.fields)).add(n_name, "long").add(ids_name, "binary").add(decoded_name, "binary")
    if offsets:
        schema = schema.add(start_name, ArrayType(IntegerType())).add(end_name, ArrayType(IntegerType()))
    with open(ranks_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())  # a vocabulary, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(shared.value, pattern)
        for block in blocks(batches, text, BLOCK_BYTES):
            ids, bounds = use.encode(block.column(text))
            n_bytes = np.concatenate(([0], np.cumsum(use.lengths[ids])))
            made = [
                pa.array(np.diff(bounds)),
                binaries(ids, bounds * 4),
                binaries(np.frombuffer(use.decode(ids), np.uint8), n_bytes[bounds]),
            ]
            if offsets:
                spans = [use.offsets(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                made += [pa.array([s[k].tolist() for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in block.schema.names if c != text] + made, names=schema.names
            )
        use.encoder.known.clear()  # the process goes on and other stages need the memory

    return rows.mapInArrow(run, schema)
