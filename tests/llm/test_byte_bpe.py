import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from orderlake.llm import byte_bpe, chunks
from orderlake.llm.common import blocks
from tests.llm.cases import HARD, empty, hard

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return byte_bpe.Codec(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    bits = ["a", "aa", " ", "  ", "\n", "\t", "é", "ß", "'s", "'", "1", "23", "!", "\u3000", "\u00a0", "中", "ا", "🙂", "the ", "\r\n", " b", "<|endoftext|>", "\x00"]
    return [*("".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(5000)), None, "", " ", "e\u0301"]


@pytest.mark.parametrize("cached", [chunks.CACHED, 50])
def test_equals_the_rank_files_own_encoding(codec, reference, monkeypatch, cached):
    monkeypatch.setattr(chunks, "CACHED", cached)
    listed = texts()
    ids, bounds = codec.encode(pa.array(listed))
    for text, a, b in zip(listed, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == reference.encode_ordinary(text or "")
        assert codec.decode(ids[a:b]) == (text or "").encode()


def test_offsets_of_split_characters(codec):
    text = "a 🙂é中"
    ids, _ = codec.encode(pa.array([text]))
    starts, ends = codec.offsets(ids)
    assert starts[0] == 0 and ends[-1] == len(text) and (np.diff(starts) >= 0).all()
    for i, (a, b) in enumerate(zip(starts, ends)):
        part = codec.decode(ids[i : i + 1])
        assert part in text[a:b].encode()  # a token's bytes lie within its characters
    assert len(codec.decode(ids[:3]).decode("utf-8", "replace")) >= 2


def test_hard_rows(spark, reference):
    found = byte_bpe.encode(hard(spark), PATH, public_tokenizers.PATTERN, offsets=True).collect()
    assert len(found) == len(HARD)
    for (doc_id, text, *_), r in zip(HARD, found):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.doc_id == doc_id and ids == reference.encode_ordinary(text or "") and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (text or "").encode() and len(r.char_start) == len(ids)
    assert byte_bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN).collect() == []


def test_blocks_in_which_texts_are_encoded_stay_small():
    """A worker takes some 50 bytes for each byte of text in a block (434 MB with blocks of 4 MB, 271 MB with 1 MB)."""
    batch = pa.record_batch({"text": ["some words " * 2_000] * 300})
    made = [block.column("text").nbytes for block in blocks([batch], "text", byte_bpe.BLOCK_BYTES)]
    assert len(made) > 5 and max(made) < 1_200_000
