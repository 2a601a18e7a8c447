from orderlake.operators import dedup
from tests.helpers import rows, ts

T1, T2 = ts("2024-01-01"), ts("2024-01-02")


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t timestamp, f string, v int").repartition(3)


def test_latest_takes_the_newest(spark):
    df = frame(spark, [("a", T1, "x", 1), ("a", T2, "x", 2), ("b", T1, "x", 3), (None, T1, "x", 4)])
    assert rows(dedup.latest(df, ["k"], "t"), "k", "v") == [(None, 4), ("a", 2), ("b", 3)]


def test_latest_decides_ties_by_file_then_values(spark):
    df = frame(spark, [("a", T1, "f1", 9), ("a", T1, "f2", 1), ("a", T1, "f2", 2)])
    for _ in range(3):
        assert rows(dedup.latest(df, ["k"], "t", ["f"]), "f", "v") == [("f2", 2)]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = frame(spark, [("a", T1, "x", i) for i in range(50)])
    plan = dedup.latest(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_exact_keeps_the_oldest_of_equal_rows(spark):
    df = frame(spark, [("a", T2, "x", 1), ("a", T1, "y", 1), ("a", T1, "z", 2)])
    assert rows(dedup.exact(df, ["k", "v"], "t"), "k", "f", "v") == [("a", "y", 1), ("a", "z", 2)]


def test_by_hash_keeps_other_times_and_null_positions(spark):
    data = [("a", T1, "p", None), ("a", T1, "p", None), ("a", T2, "p", None), ("a", T1, None, 1)]
    df = frame(spark, data)
    assert dedup.by_hash(df, "k", ["f", "v"], "t").count() == 3


def test_by_hash_null_skipping_lets_shifted_values_collide(spark):
    df = spark.createDataFrame(
        [("k", T1, "a", None), ("k", T1, None, "a")], "k string, t timestamp, x string, y string"
    )
    assert dedup.by_hash(df, "k", ["x", "y"], "t").count() == 2
    assert dedup.by_hash(df, "k", ["x", "y"], "t", null_skipping=True).count() == 1


def test_any_row_is_repeatable(spark):
    df = frame(spark, [("a", T1, "x", 1), ("a", T2, "y", 2)])
    assert rows(dedup.any_row(df, ["k"]), "v") == rows(dedup.any_row(df.repartition(1), ["k"]), "v")


def test_duplicate_keys_and_rejection_of_all_copies(spark):
    df = frame(spark, [("a", T1, "x", 1), ("a", T2, "y", 2), ("b", T1, "z", 3)])
    assert rows(dedup.duplicate_keys(df, ["k"])) == [("a",)]
    unique, repeated = dedup.reject_duplicates(df, ["k"])
    assert rows(unique, "k") == [("b",)]
    assert rows(repeated, "k", "v") == [("a", 1), ("a", 2)]
