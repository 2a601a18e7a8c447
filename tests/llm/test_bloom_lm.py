import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import bloom_lm
from tests.llm.cases import HARD, empty, hard, white_words


def sequence(text):
    return [*white_words(text), None]


def out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_tokens_and_grams():
    listed = ["A b  a\x0bb", None, "", " x ", "É é"]
    flat, starts = bloom_lm.tokens(pa.array(listed))
    assert np.diff(starts).tolist() == [len(sequence(t)) for t in listed]
    assert flat[0] == flat[2] and flat[1] == flat[3] and flat[4] == flat[5] and flat[-3] != flat[-2]
    two = bloom_lm.grams(flat, starts, 2)[1]
    assert two[0] != two[2] and two[1] == two[3] and two[5] == two[6]


def test_levels_are_never_too_low():
    rng = np.random.default_rng(1)
    hashes, counts = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)), None
    counts = rng.geometric(0.3, len(hashes)) ** 3
    bits, _ = bloom_lm.build_part(hashes, counts)
    block = bloom_lm.FilterBlock(bits, np.zeros(1, np.int64), np.array([len(bits) * 8], np.uint64))
    found = block.levels(hashes)
    assert (found >= bloom_lm.level(counts)).all() and (found == bloom_lm.level(counts)).mean() > 0.97
    others = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (block.levels(others) > 0).mean() < 0.03


def check(found, rows):
    trained = [sequence(t) for d, t, *_ in rows if not out(d)]
    counts = Counter(w for s in trained for w in s)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            str(d), len(sequence(t)), sum(counts[w] > 0 for w in sequence(t)), n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in sequence(t)), 5),
        )
        for d, t, *_ in rows
    )
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert all(abs(g[4] - e[4]) <= 1e-9 * abs(e[4]) + 2e-5 for g, e in zip(got, expected))


def scores(spark):
    docs = hard(spark)
    return bloom_lm.score(docs, docs.filter(~bloom_lm.held_out())).collect()


@pytest.fixture(scope="module")
def usual(spark):
    return scores(spark)


def test_base_scores(usual):
    check(usual, HARD)
    assert all(r.score <= 0 for r in usual)


def test_rare_tokens_by_the_join(spark, monkeypatch, usual):
    monkeypatch.setattr(bloom_lm, "HEAD", 3)
    found = scores(spark)
    check(found, HARD)
    assert sorted(r.score for r in found) == sorted(r.score for r in usual)


def test_filter_in_several_blocks(spark, monkeypatch, usual):
    monkeypatch.setattr(bloom_lm, "BUCKET_TEXT", 4000)
    whole = scores(spark)
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 20_000)
    found = scores(spark)
    check(found, HARD)
    assert sorted(r.score for r in found) == sorted(r.score for r in whole)


def test_the_model_prefers_what_it_has_seen(spark):
    seen = [(i, "one two three four five six seven eight") for i in range(50)]
    asked = [(100, "one two three four five six seven eight"), (101, "eight three one seven two six five four"), (102, "nothing of all that was ever there before")]
    schema = "doc_id long, text string"
    found = {r.doc_id: r.score for r in bloom_lm.score(spark.createDataFrame(asked, schema), spark.createDataFrame(seen, schema), order=3).collect()}
    assert found[100] > found[101] > found[102]


def test_empty(spark):
    assert bloom_lm.score(empty(spark), empty(spark)).collect() == []
    found = bloom_lm.score(hard(spark), empty(spark)).collect()
    assert len(found) == len(HARD) and {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}
    assert {r.base_score for r in found} == {0.0}
