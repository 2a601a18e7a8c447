import random

import pytest
import xxhash
from pyspark.sql import functions as F

from orderlake.llm import common, simhash
from orderlake.llm.components import components
from tests.llm.cases import HARD, empty, hard, reachable, white_words


def plain_fingerprint(text):
    words = white_words(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_fingerprint():
    for _, text, *_ in HARD:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)
    assert simhash.fingerprint(b"A b\x0bC d a b c") == plain_fingerprint("a B c D\na b c")


def test_hard_rows(spark):
    found = simhash.near_duplicates(hard(spark)).collect()
    assert len(found) == len(HARD)
    prints = {r.fingerprint & (1 << 64) - 1 for r in found}
    roots = reachable(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    by_root = {}
    for r in found:
        by_root.setdefault(roots[r.fingerprint & (1 << 64) - 1], []).append(r)
    for rows in by_root.values():
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert {r.component_id for r in rows} == {min(ids, default=None)}
    kept = simhash.deduplicate(hard(spark))
    assert kept.columns == hard(spark).columns
    assert kept.count() == len(by_root)
    assert not [r for r in kept.collect() if r.doc_id == 4]


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.deduplicate(empty(spark)).collect() == []


def near_group(rng, n):
    base = rng.getrandbits(64)
    places = rng.sample(range(64), 14)
    group = {base}
    while len(group) < n:
        value = base
        for b in rng.sample(places, rng.randint(1, 4)):
            value ^= 1 << b
        group.add(value)
    return group


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(7)
    for bits in (1, 3):
        # a crowd that shares most bits, pairs at the limit and just beyond, strangers, zero
        values = near_group(rng, 250) | {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
        for v in rng.sample(sorted(values), 60):
            for far in (bits, bits + 1):
                for b in rng.sample(range(64), far):
                    v ^= 1 << b
                values.add(v)
        prints = spark.createDataFrame([(signed(v),) for v in sorted(values)], "fingerprint long")
        links = simhash.links(prints, bits)
        expected = reachable({signed(v) for v in values}, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= bits)
        found = {r.node: r.root for r in components(links).collect()}
        assert {v: found.get(v, v) for v in expected} == expected


def scattered_group(rng, n, flips, places=64):
    """Around one value, each some flips away in any of the places."""
    base, group = rng.getrandbits(64), set()
    while len(group) < n:
        value = base
        for b in rng.sample(range(places), rng.randint(0, flips)):
            value ^= 1 << b
        group.add(value)
    return group


def test_crowded_buckets_list_no_pairs(spark):
    rng = random.Random(3)
    group = near_group(rng, 1400)
    prints = spark.createDataFrame([(signed(v),) for v in sorted(group)], "fingerprint long")
    links = simhash.links(prints, 3).distinct().count()
    pairs = sum((a ^ b).bit_count() <= 3 for a in group for b in group if a < b)
    assert links < 20 * len(group) < pairs / 3


def test_dense_groups_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    for bits, compared in ((1, 100), (2, 1 << 24), (3, 1 << 24), (3, 2000)):
        monkeypatch.setattr(simhash, "COMPARED", compared)
        values = scattered_group(rng, 300, 8) | scattered_group(rng, 200, 5, 20) | scattered_group(rng, 80, 3, 8)
        whole = spark.createDataFrame([(signed(v), -1) for v in sorted(values)], "fp long, mask long")
        expected = reachable({signed(v) for v in values}, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= bits)
        found = {r.node: r.root for r in components(simhash._dense(whole, bits)).collect()}
        assert {v: found.get(v, v) for v in expected} == expected


def test_splitting_makes_rows_in_proportion(spark):
    """Rows out of the Python stage: a bounded number for each crowded fingerprint."""
    rng = random.Random(5)
    for n in (200, 1000):
        group = scattered_group(rng, n, 9, 50)
        made = 0
        split = simhash._split

        def counted(members, bits):
            nonlocal made
            made += members.count() * 56
            return split(members, bits)

        simhash._split = counted
        try:
            simhash._dense(spark.createDataFrame([(signed(v), -1) for v in sorted(group)], "fp long, mask long"), 3).count()
        finally:
            simhash._split = split
        assert made <= 80 * n


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(7, 7), (60, 61), (61, 60)], "a long, b long")
    found = {r.node: r.root for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 61: 60} | {k: v for k, v in found.items() if k == v}


def test_thresholds_follow_the_costs():
    costs = [[1, 5, 9, 20], [50, 90, 99, 200], [2, 6, 30, 70]]
    assert simhash.thresholds(costs, 3)[0] in ([1, -1, 1], [2, -1, 0])
    assert simhash.thresholds(costs, 3)[1] == 11


@pytest.mark.parametrize("buckets", [1, 7, simhash.BUCKETS])
def test_what_stays_does_not_depend_on_the_places(spark, monkeypatch, buckets):
    monkeypatch.setattr(simhash, "BUCKETS", buckets)
    rows = [(i, f"plain words of text number {i % 40} and no other") for i in range(120)] * 2 + [(None, None), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_place", F.lit("own"))
    found = simhash.deduplicate(df)
    kept = simhash.near_duplicates(df).filter("keep").select("doc_id", "_h1", "_h2").distinct()
    assert found.columns == df.columns
    left = found.select("doc_id", *common.text_key()).collect()
    assert sorted(map(str, left)) == sorted(map(str, kept.collect()))
