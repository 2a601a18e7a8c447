import hashlib
import random

import numpy as np
import pytest

from orderlake.llm import syncmers
from tests.llm.cases import HARD, empty, hard


def plain_anchors(text, k=16, s=6):
    """Places of closed syncmers, window by window, from the operator's own s-mer hashes."""
    codes = [np.uint64(ord(c)) for c in text]
    with np.errstate(over="ignore"):
        grams = []
        for i in range(len(codes) - s + 1):
            value = codes[i]
            for j in range(1, s):
                value = value * np.uint64(0x9E3779B97F4A7C15) + codes[i + j]
            grams.append(int(syncmers._mix(np.array([value], np.uint64))[0]))
    width = k - s + 1
    found = []
    for i in range(len(text) - k + 1):
        window = grams[i : i + width]
        if min(window) in (window[0], window[-1]):
            found.append(i)
    return found


def test_anchors_are_closed_syncmers():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeé🙂 ") for _ in range(n)) for n in (0, 3, 15, 16, 17, 300, 0, 40)]
    text, place, _ = syncmers.anchors(texts)
    for i, t in enumerate(texts):
        assert place[text == i].tolist() == plain_anchors(t)


def test_anchors_are_context_free():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    one, two = " ".join(words), "some thing before it " + " ".join(words) + " and after"
    text, _, value = syncmers.anchors([one, two])
    assert set(value[text == 0]) <= set(value[text == 1])


def test_likeness():
    rng = random.Random(3)
    t = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    u = " ".join("".join(rng.choice("ijklmnop") for _ in range(6)) for _ in range(400))
    half = t[: len(t) // 2] + u[: len(t) // 2]
    a, b, c, none, short = syncmers.fingerprints([t, u, half, "", "short"])
    assert syncmers.likeness(a, a) == 1 and syncmers.likeness(a, b) == 0
    assert 0.1 < syncmers.likeness(a, c) < 0.7 and syncmers.likeness(a, c) == syncmers.likeness(c, a)
    assert none == [] and syncmers.likeness(none, none) == 1 and syncmers.likeness(none, short) == 0
    assert len(short) == 1 and syncmers.shown(none) == ""


def plain_likeness(one, other):
    """From every anchor of both texts, the longest common run by the quadratic recurrence."""
    text, place, value = syncmers.anchors([one, other])
    firsts = []
    for t in (0, 1):
        first = {}
        for h, p in sorted(zip(value[text == t].tolist(), place[text == t].tolist()), key=lambda x: x[1]):
            first.setdefault(h, p)
        firsts.append(first)
    left, right = firsts
    places = [right[h] for h in left if h in right]  # in the order of the first text
    best = []
    for i, p in enumerate(places):
        best.append(1 + max((best[j] for j in range(i) if places[j] < p), default=0))
    return max(best, default=0) / len(left.keys() | right.keys())


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_likeness_of_long_texts_rests_on_all_anchors():
    rng = random.Random(5)
    shared = words(rng, "abcdefgh", 300)
    one, two = (words(rng, letters, 4000) + " " + shared + " " + words(rng, letters, 4000) for letters in ("ijklmnop", "qrstuvwx"))
    parts = [words(rng, "abcdefgh", 40) for _ in range(8)]
    moved = rng.sample(parts, 8)
    pairs = [(one, two), (" ".join(parts), " ".join(moved)), (one, one[:30_000] + two[:400] + one[30_400:]), (one[:9_000] * 2, one)]
    for a, b in pairs:
        left, right = syncmers.fingerprints([a, b])
        assert syncmers.likeness(left, right) == syncmers.likeness(right, left) == plain_likeness(a, b)
        assert 0 < syncmers.likeness(left, right) < 1


def test_fingerprint_shows_any_change_of_a_long_text():
    rng = random.Random(6)
    text = words(rng, "abcdefgh", 6000)
    changed = [text[:at] + "x" * 40 + text[at + 40 :] for at in range(0, len(text) - 40, 2000)]
    prints = syncmers.fingerprints([text, *changed])
    assert len({syncmers.shown(p) for p in prints}) == len(prints)
    assert all(syncmers.likeness(prints[0], p) < 1 for p in prints[1:])


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]
    prints = syncmers.fingerprints(texts)
    out = []
    for i, r in enumerate(order):
        j = (i + 1) % len(order)
        changed = texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[j][: len(texts[i]) // 2]
        (after,) = syncmers.fingerprints([changed])
        out.append((
            str(r[0]), len(texts[i]), hashlib.sha256(changed.encode()).hexdigest(), syncmers.shown(prints[i]), syncmers.shown(after),
            syncmers.likeness(prints[i], after), syncmers.likeness(prints[i], prints[j]),
        ))
    return sorted(out)


@pytest.mark.parametrize("size", [syncmers.RANGE_BYTES, 30_000, 200])
def test_hard_rows(spark, monkeypatch, size):
    monkeypatch.setattr(syncmers, "RANGE_BYTES", size)
    found = syncmers.compare(hard(spark)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected(HARD)


def test_many_ranges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 3000)
    rng = random.Random(4)
    rows = [(rng.randint(-50, 400), "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 120)))) for _ in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((str(r[0]), *r[1:]) for r in syncmers.compare(df).collect()) == expected(rows)


def test_one_row_and_none(spark):
    one = [(7, "only this text, followed by itself")]
    found = syncmers.compare(spark.createDataFrame(one, "doc_id long, text string")).collect()
    assert [(str(r[0]), *r[1:]) for r in found] == expected(one)
    assert syncmers.compare(empty(spark)).collect() == []


def test_one_id_fills_many_ranges(spark, monkeypatch):
    """A third of the rows without id, a third under one id; each range takes its share."""
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 2000)
    rng = random.Random(8)
    ids = [None] * 200 + [7] * 200 + list(range(200))
    rows = [(i, "".join(rng.choice("aé🙂d ") for _ in range(rng.randint(0, 60)))) for i in ids]
    rows += [(None, "same"), (None, "same"), (7, "z" * 150 + "b"), (7, "z" * 150 + "a"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((str(r[0]), *r[1:]) for r in syncmers.compare(df).collect()) == expected(rows)
    plain = df.selectExpr("coalesce(doc_id, -9223372036854775808) as id", "coalesce(text, '') as text")
    ranges = syncmers._ranges(plain, 20)
    table = plain.select("id", syncmers._head(ranges)).toArrow()
    sizes = np.bincount(ranges.place(table["id"].to_numpy(), table["head"]))
    assert len(sizes) > 12 and sizes.max() < len(rows) / 6
