import random
import re

import pytest

from orderlake.llm import decontaminate
from tests.llm.cases import HARD, LONG, SCHEMA, ascii_lower, empty, hard


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def plain(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit)))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


ITEMS = [
    (1, "quick brown fox jumps over the lazy dog near the river bank"),
    (2, "QUICK, brown-fox jumps; over the lazy dog near the RIVER bank"),
    (3, "Straße"),
    (4, None),
    (5, "..."),
    (None, "same id as"),
    (6, " ".join(LONG.split()[9_990:10_020])),
    (6, "x"),
    (7, "over the over the over the over the over the"),
]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1500])
def test_hard_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    found = sorted((tuple(r) for r in decontaminate.contamination(hard(spark), items(spark)).collect()), key=key)
    expected = sorted(plain([r[:2] for r in HARD], ITEMS), key=key)
    assert found == expected
    assert sum(r[4] for r in expected) >= 7


def test_random_words(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    few = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for size in (1, 4):
        found = decontaminate.contamination(df, spark.createDataFrame(few, "item_id long, text string"), size).collect()
        assert sorted(map(tuple, found)) == sorted(plain(docs, few, size))


def test_clean_keeps_the_rest(spark):
    kept = decontaminate.clean(hard(spark), items(spark))
    assert kept.columns == hard(spark).columns
    expected = [d for d, r in zip(HARD, plain([r[:2] for r in HARD], ITEMS)) if not r[4]]
    assert sorted(map(key, (tuple(r)[:5] for r in kept.collect()))) == sorted(map(key, expected))


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty(spark), items(spark)).collect() == []
    assert not any(r.contaminated for r in decontaminate.contamination(hard(spark), none).collect())
    assert decontaminate.clean(hard(spark), none).count() == len(HARD)
    assert spark.createDataFrame([], SCHEMA).count() == 0


def test_no_python_in_the_plan(spark):
    plan = decontaminate.contamination(hard(spark), items(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
