import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlake.llm import records
from tests.llm.cases import HARD, empty, hard

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_checksum():
    assert records.crc32c([b"123456789", b"", b"a", bytes(32)]).tolist() == [0xE3069283, 0, 0xC1D04330, 0x8A9136AA]
    long = np.arange(5000, dtype=np.uint8).tobytes()
    value = 0xFFFFFFFF
    for byte in long:
        value ^= byte
        for _ in range(8):
            value = value >> 1 ^ (0x82F63B78 if value & 1 else 0)
    assert records.crc32c([b"xyz", long]).tolist()[1] == value ^ 0xFFFFFFFF


def test_frames():
    payloads = [b"", b"ab", bytes(range(256)) * 9]
    made = records.frames(payloads)
    assert [struct.unpack_from("<Q", m)[0] for m in made] == [len(p) for p in payloads]
    assert records.unframed(made) == payloads
    for spot in (0, 9, 14, len(made[2]) - 1):
        broken = bytearray(made[2])
        broken[spot] ^= 4
        with pytest.raises(ValueError, match="damaged"):
            records.unframed([bytes(broken)])


def expected():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    order = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, out = 0, []
    for doc_id, text, *_ in order:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, at, np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def test_round_trip(spark, tmp_path):
    index = records.write(hard(spark), f"file://{tmp_path}/r", PATH, 1, shards=3)
    assert len(list((tmp_path / "r").glob("*.records"))) == 3
    rows = [(r.doc_id, r.start, bytes(r.ids)) for r in records.read(index, f"file://{tmp_path}/r").collect()]
    assert sorted(rows, key=lambda r: r[1]) == expected()
    one = index.orderBy("bytes").limit(4)  # any rows of the index, in any order
    assert {(r.start, zlib.crc32(r.ids)) for r in records.read(one, f"file://{tmp_path}/r").collect()} <= {
        (s, zlib.crc32(b)) for _, s, b in expected()
    }


def test_files_hold_the_records_in_order(spark, tmp_path):
    records.write(hard(spark), f"file://{tmp_path}/r", PATH, 1, shards=2)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "r").glob("*.records")))
    found, at = [], 0
    while at < len(data):
        (length,) = struct.unpack_from("<Q", data, at)
        found.append(data[at : at + length + 16])
        at += length + 16
    ids = [np.frombuffer(p, "<u2").astype("<u4").tobytes() for p in records.unframed(found)]
    assert ids == [b for _, _, b in expected()]


def test_empty(spark):
    assert records.round_trip(empty(spark), PATH, 1).collect() == []
