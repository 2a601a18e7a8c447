import math
import random

import pytest
from pyspark.sql import functions as F

from orderlake.functions.money import PARTS, from_parts, parts_of
from orderlake.functions import date_key, exact_avg, exact_sum, record_hash, surrogate_key
from tests.helpers import rows, ts


def test_date_key_is_the_day_and_null_safe(spark):
    df = spark.createDataFrame([(ts("2024-03-09 23:59:59"),), (None,)], "t timestamp")
    assert rows(df, date_key("t")) == [(None,), (20240309,)]
    assert dict(df.select(date_key("t").alias("k")).dtypes) == {"k": "int"}


def test_surrogate_key_treats_null_as_empty_and_keeps_column_borders(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("ab", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert keys[0] == keys[1]
    assert len(set(keys)) == 3


def test_record_hash_tells_null_positions_apart_unless_asked_not_to(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    exact = {r[0] for r in df.select(record_hash("x", "y", "z")).collect()}
    skipping = {r[0] for r in df.select(record_hash("x", "y", "z", null_skipping=True)).collect()}
    assert len(exact) == 2
    assert len(skipping) == 1


def test_sums_do_not_depend_on_row_order(spark):
    amounts = [random.Random(7).uniform(0, 99999) ** pick for pick in (1, 0.5, 2) for _ in range(700)] + [None]
    amounts += [random.Random(i).uniform(-1e-9, 1e6) for i in range(2000)]
    shuffled = amounts[:]
    random.Random(8).shuffle(shuffled)
    known = [v for v in amounts if v is not None]
    results = set()
    for values in (amounts, shuffled, sorted(amounts, key=lambda v: v or 0)):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
        results.add(tuple(df.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()))
    # fsum is the correctly rounded sum
    assert results == {(math.fsum(known), math.fsum(known) / len(known))}


def test_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert tuple(df.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()) == (None, None)


def _summed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "values",
    [
        [0.004] * 1000,
        [0.0001, 1.23456789, -0.5],
        [9e11 + 0.25] * 40 + [-0.5],
        [4e-10] * 1000,
        [-4e-10] * 1000,
        [1e15, -1e15, 3e-7],
        [-0.3, 0.1, 0.1],
        [2.0**-60, 1.0, -1.0],
        [4398046511103.75] * 9 + [-4398046511104.0],
        [1e17, 0.5],
        [1e300, -1e300, 7.0],
    ],
)
def test_sums_lose_nothing(spark, values):
    assert _summed(spark, [*values, None]) == math.fsum(values)


def test_many_rows_equal_the_plain_sum(spark):
    """A million amounts below a billionth, and more than a bigint holds."""
    for amount, n in ((4e-10, 1_000_000), (9.9e11, 20_000_000)):
        got, plain = spark.range(n).select(F.lit(amount).alias("v")).agg(exact_sum(F.col("v")), F.sum("v")).first()
        assert math.isclose(got, amount * n, rel_tol=1e-12) and math.isclose(got, plain, rel_tol=1e-9)


def test_sums_pass_on_what_does_not_split(spark):
    assert math.isnan(_summed(spark, [1.0, float("nan")]))
    assert _summed(spark, [1.0, float("inf")]) == float("inf")


def test_parts_can_be_summed_again(spark):
    df = spark.createDataFrame([(k % 3, 0.1) for k in range(30)], "k int, v double")
    per_key = df.groupBy("k").agg(*[c.alias(name) for c, name in zip(parts_of(F.col("v")), PARTS)])
    assert per_key.agg(from_parts(*[F.sum(name) for name in PARTS])).first()[0] == 3.0
