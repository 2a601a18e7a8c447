import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake import feeds
from orderlake.operators import scd
from tests.helpers import rows, ts

T = [ts(f"2024-01-{d:02d}") for d in range(1, 10)]
COLUMNS = ["k", "v", scd.FROM, scd.TO, scd.ACTIVE]


def changes(spark, data):
    return spark.createDataFrame(data, "k string, t timestamp, v string").repartition(3)


def dated(spark, data, **options):
    return scd.versions(changes(spark, data), "k", "t", ["v"], **options)


def test_versions_end_where_the_next_starts(spark):
    got = dated(spark, [("a", T[2], "y"), ("a", T[0], "x"), ("b", T[1], "z")])
    assert rows(got) == [
        ("a", "x", T[0], T[2], False),
        ("a", "y", T[2], None, True),
        ("b", "z", T[1], None, True),
    ]


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_slicing_a_key_by_time_changes_nothing(spark, unit):
    pick = random.Random(3)
    data = [("hot", T[0] + timedelta(minutes=7 * i), str(pick.random())) for i in range(300)]
    data += [(f"k{i % 40}", T[0] + timedelta(hours=pick.randrange(2000)), str(i)) for i in range(400)]
    assert rows(dated(spark, data, slice_by=unit)) == rows(dated(spark, data))


def test_equal_starts_collapse_or_stay_as_empty_versions(spark):
    data = [("a", T[0], "x"), ("a", T[0], "y"), ("a", T[1], "z")]
    assert rows(dated(spark, data), "v", scd.TO) == [("y", T[1]), ("z", None)]
    kept = dated(spark, data, keep_ties=True)
    assert rows(kept, "v", scd.TO) == [("x", T[0]), ("y", T[1]), ("z", None)]


@pytest.mark.parametrize("unit", [None, "hour", "day"])
def test_kept_ties_equal_a_plain_lead(spark, unit):
    pick = random.Random(11)
    data = {("hot", T[0], f"{i:03d}") for i in range(120)}
    data |= {(f"k{pick.randrange(5)}", T[0] + timedelta(hours=pick.randrange(60)), f"{i:03d}") for i in range(150)}
    got = dated(spark, list(data), keep_ties=True, slice_by=unit)
    by_key = {}
    for k, t, v in sorted(data):
        by_key.setdefault(k, []).append((t, v))
    expected = set()
    for k, events in by_key.items():
        for (t, v), following in zip(events, events[1:] + [(None, None)]):
            expected.add((k, v, t, following[0], following[0] is None))
    assert {tuple(r) for r in got.collect()} == expected


def test_open_ended_leaves_all_active(spark):
    got = dated(spark, [("a", T[0], "x"), ("a", T[1], "y")], open_ended=True)
    assert rows(got, "v", scd.TO, scd.ACTIVE) == [("x", None, True), ("y", None, True)]


def test_worked_example_of_a_merge(spark):
    target = dated(spark, [("k", T[0], "old"), ("other", T[0], "o")])
    incoming = dated(spark, [("k", T[1], "v2"), ("k", T[2], "v3"), ("new", T[1], "n")])
    expected = [
        ("k", "old", T[0], T[1], False),
        ("k", "v2", T[1], T[2], False),
        ("k", "v3", T[2], None, True),
        ("new", "n", T[1], None, True),
        ("other", "o", T[0], None, True),
    ]
    assert rows(scd.apply(target, incoming, "k")) == expected
    closed, live = scd.merge_parts(scd.active(target), incoming, "k")
    assert rows(closed.unionByName(live)) == expected
    assert all(not r.IsActive for r in closed.collect()) and all(r.IsActive for r in live.collect())


def test_closed_history_is_not_touched(spark):
    target = dated(spark, [("k", T[0], "a"), ("k", T[1], "b")])
    got = scd.apply(target, dated(spark, [("k", T[4], "c")]), "k")
    assert rows(got, "v", scd.TO) == [("a", T[1]), ("b", T[4]), ("c", None)]


def test_one_active_row_per_key_and_no_gaps(spark):
    pick = random.Random(5)
    table = None
    for batch in range(4):
        data = {(f"k{pick.randrange(20)}", T[0] + timedelta(hours=100 * batch + pick.randrange(99))) for _ in range(40)}
        incoming = dated(spark, [(k, t, str(t)) for k, t in data])
        table = incoming if table is None else scd.apply(table, incoming, "k")
    by_key = {}
    for r in table.collect():
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.EffectiveFrom)
        assert [r.IsActive for r in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a.EffectiveTo == b.EffectiveFrom for a, b in zip(versions, versions[1:]))


@pytest.mark.parametrize("unit", [None, "day"])
def test_unchanged_rows_can_be_dropped(spark, unit):
    current = scd.active(dated(spark, [("a", T[0], "x"), ("b", T[0], "x")]))
    incoming = dated(
        spark, [("a", T[1], "x"), ("a", T[2], "y"), ("a", T[3], "y"), ("b", T[1], "y"), ("b", T[2], "x"), ("c", T[1], "x")]
    )
    got = scd.drop_unchanged(current, incoming, "k", ["v"], unit)
    assert rows(got) == [
        ("a", "y", T[2], None, True),
        ("b", "x", T[2], None, True),
        ("b", "y", T[1], T[2], False),
        ("c", "x", T[1], None, True),
    ]


def test_rebuild_repairs_late_versions(spark):
    late = scd.apply(dated(spark, [("a", T[5], "new"), ("b", T[0], "b")]), dated(spark, [("a", T[1], "old")]), "k")
    assert any(r.EffectiveTo and r.EffectiveTo < r.EffectiveFrom for r in late.collect())
    fixed = scd.rebuild(late, "k", late.where("k = 'a'"))
    assert rows(fixed) == [
        ("a", "new", T[5], None, True),
        ("a", "old", T[1], T[5], False),
        ("b", "b", T[0], None, True),
    ]
    assert rows(scd.rebuild(late, "k")) == rows(fixed)


@pytest.mark.parametrize("unit", [None, "day"])
def test_rebuild_keeps_every_row(spark, unit):
    schema = "k string, v string, EffectiveFrom timestamp, EffectiveTo timestamp, IsActive boolean"
    data = [("a", "z", T[1], T[1], False), ("a", "y", T[1], None, True), ("a", "x", T[0], T[1], False), ("a", "x", T[0], T[1], False)]
    df = spark.createDataFrame(data, schema)
    assert rows(scd.rebuild(df, "k", slice_by=unit)) == rows(
        spark.createDataFrame([("a", "z", T[1], T[1], False), ("a", "y", T[1], None, True), ("a", "x", T[0], T[0], False), ("a", "x", T[0], T[1], False)], schema)
    )


def test_unchanged_compares_values_not_their_text(spark):
    schema = "k string, v string, w string, EffectiveFrom timestamp, EffectiveTo timestamp, IsActive boolean"
    current = spark.createDataFrame([("a", "a||b", "c", T[0], None, True), ("b", None, "x", T[0], None, True), ("c", None, "x", T[0], None, True)], schema)
    incoming = spark.createDataFrame([("a", "a", "b||c", T[1], None, True), ("b", None, "x", T[1], None, True), ("c", "", "x", T[1], None, True)], schema)
    assert [r[0] for r in rows(scd.drop_unchanged(current, incoming, "k", ["v", "w"]), "k")] == ["a", "c"]


@pytest.mark.parametrize("unit", [None, "hour", "day"])
@pytest.mark.parametrize("changed_only", [False, True])
def test_replay_equals_merging_batch_by_batch(spark, unit, changed_only):
    pick = random.Random(17)
    data = {}
    for _ in range(500):
        key = pick.choice([None, "hot", "hot", "hot", *"abcdefgh"])
        batch = pick.choice([1, 2, 3])
        # batches overlap in time; few states, so many versions change nothing
        start = T[0] + timedelta(hours=pick.randrange(40 * batch), minutes=pick.choice([0, 0, 30]))
        data[key, batch, start] = (key, start, pick.choice(["x", "y", None]), batch)
    df = spark.createDataFrame(list(data.values()), "k string, t timestamp, v string, n int").repartition(3)
    got = scd.replay(df, "k", "t", ["v"], "n", slice_by=unit, changed_only=changed_only)
    expected = []
    for key in {d[0] for d in data.values()}:
        kept = []
        for _, start, state, _ in sorted((d for d in data.values() if d[0] == key), key=lambda d: (d[3], d[1])):
            if not (changed_only and kept and kept[-1][1] == state):
                kept.append((start, state))
        for (start, state), after in zip(kept, [*kept[1:], (None, None)]):
            expected.append((key, state, start, after[0], after[0] is None))
    assert rows(got) == rows(spark.createDataFrame(expected, got.schema))
    if key is not None or unit:
        one = got.where("k = 'hot'")
        assert one.where(scd.ACTIVE).count() == 1


def test_replay_collapses_equal_starts_of_a_batch(spark):
    df = spark.createDataFrame([("a", T[0], "x", 1), ("a", T[0], "y", 1), ("a", T[0], "z", 2)], "k string, t timestamp, v string, n int")
    for unit in (None, "day"):
        got = scd.replay(df, "k", "t", ["v"], "n", slice_by=unit)
        assert rows(got, "v", scd.FROM, scd.TO) == [("y", T[0], T[0]), ("z", T[0], None)]


def test_changes_in_one_pass(spark, sf_dir):
    """At most four scans and twelve exchanges, however the batches are told apart."""
    from orderlake import registry

    for name in ("scd2_changes_only", "scd2_rebuild"):
        plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
        executed = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 4
        assert executed.count("Exchange hashpartitioning") + executed.count("BroadcastExchange") <= 12


def test_rebuild_can_drop_what_changes_nothing(spark):
    late = scd.apply(dated(spark, [("a", T[5], "x"), ("b", T[0], "b")]), dated(spark, [("a", T[1], "x"), ("a", T[2], "x")]), "k")
    assert rows(scd.rebuild(late, "k", late.where("k = 'a'"), changed_only=True)) == [
        ("a", "x", T[1], None, True),
        ("b", "b", T[0], None, True),
    ]


def test_upsert_replaces_and_adds(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    source = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    assert rows(scd.upsert(target, source, "k")) == [("a", 1), ("b", 3), ("c", 4)]


def merge(spark, source, **options):
    target = spark.createDataFrame([("a", 1, True), ("b", 2, True), ("c", 3, False)], "k string, v int, live boolean")
    s = {c: F.col(f"source.{c}") for c in ("k", "v")}
    return scd.merge(
        target,
        spark.createDataFrame(source, "k string, v int"),
        ["k"],
        update={"v": F.col("v") + s["v"]},
        insert={"k": s["k"], "v": s["v"]},
        **options,
    )


def test_general_merge(spark):
    got = merge(
        spark,
        [("a", 10), ("c", 30), ("d", 40), ("e", -1), (None, 5)],
        match_when=F.col("live"),
        insert_when=F.col("source.v") > 0,
    )
    assert rows(got) == [
        (None, 5, None),
        ("a", 11, True),
        ("b", 2, True),
        ("c", 3, False),
        ("c", 30, None),
        ("d", 40, None),
    ]


def test_two_source_rows_for_one_target_row_are_an_error(spark):
    with pytest.raises(PySparkException):
        merge(spark, [("a", 1), ("a", 2)]).collect()
    assert merge(spark, [("x", 1), ("x", 2)]).count() == 5


def test_event_feed_as_two_batches(spark):
    """Known counts: batch 2 without every third user, at the middle scale."""
    all_changes = feeds.Tables(spark, "/root/testdata/sf0.01")["events"].select(
        F.col("user_id").alias("k"), F.col("ts").cast("timestamp").alias("t"), F.col("event_type").alias("v")
    )
    cut = F.col("t") < F.lit("2024-01-15").cast("timestamp")
    first = scd.versions(all_changes.where(cut), "k", "t", ["v"], slice_by="day")
    second = scd.versions(all_changes.where(~cut & (F.col("k") % 3 != 0)), "k", "t", ["v"], slice_by="day")
    merged = scd.apply(first, second, "k")
    assert merged.count() == 8202
    assert scd.active(merged).count() == scd.active(merged).select("k").distinct().count() == 150


def test_merged_rows_come_from_one_join_and_split_into_both_parts(spark):
    columns = "k string, v string, EffectiveFrom timestamp, EffectiveTo timestamp, IsActive boolean"
    old, new = ts("2024-01-01"), ts("2024-02-01")
    current = spark.createDataFrame(
        [("a", "1", old, None, True), ("b", "1", old, None, True), (None, "1", old, None, True)], columns
    )
    incoming = spark.createDataFrame([("a", "2", new, None, True), ("c", "0", old, new, False)], columns)
    merged = scd.merge_rows(current, incoming, "k")
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    closed, live = scd.merge_parts(current, incoming, "k")
    assert rows(closed) == [("a", "1", old, new, False), ("c", "0", old, new, False)]
    assert rows(live) == [(None, "1", old, None, True), ("a", "2", new, None, True), ("b", "1", old, None, True)]
    assert rows(merged) == rows(closed.unionByName(live))
