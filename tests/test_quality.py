import pytest
from pyspark.sql import functions as F

from orderlake.operators import quality
from orderlake.operators.quality import Rule
from tests.helpers import names, rows

SCHEMA = "id string, kind string, price double"


def check(spark, data, rules, schema=SCHEMA, **options):
    checked = quality.apply(spark.createDataFrame(data, schema), rules, **options)
    return {r[0]: r for r in checked.collect()}


def test_not_null(spark):
    got = check(spark, [("1", None, 1.0), ("2", "x", 1.0)], [Rule.not_null("kind")])
    assert names(got["1"]) == ["kind_not_null"]
    assert got["1"]._errors[0].columns == ["kind"]
    assert got["2"]._errors is None


def test_in_list_refuses_null_and_others(spark):
    data = [("1", None, 1.0), ("2", "x", 1.0), ("3", "it's", 1.0)]
    got = check(spark, data, [Rule.in_list("kind", ["it's", "y"], "warn")])
    assert [names(got[k], "_warnings") for k in "123"] == [["kind_valid"], ["kind_valid"], []]
    assert got["1"]._errors is None


def test_expression_passes_when_unknown(spark):
    got = check(
        spark, [("1", "x", None), ("2", "x", -1.0), ("3", "x", 1.0)], [Rule.expr("pos", "price > 0", "!")]
    )
    assert [names(got[k]) for k in "123"] == [[], ["pos"], []]


def test_unique_fails_every_copy_and_passes_missing_keys(spark):
    data = [("1", "a", 1.0), ("2", "a", 1.0), ("3", "b", 1.0), ("4", None, 1.0), ("5", None, 1.0)]
    got = check(spark, data, [Rule.unique(["kind"])])
    assert [bool(got[k]._errors) for k in "12345"] == [True, True, False, False, False]


def test_unique_after_dedup_needs_no_join(spark):
    data = [("1", "a", 1.0), ("2", "a", 1.0), ("3", None, 1.0), ("4", None, 1.0)]
    df = spark.createDataFrame(data, SCHEMA)
    checked = quality.apply(df, [Rule.unique(["kind"], deduplicated=True)])
    assert [bool(r._errors) for r in checked.orderBy("id").collect()] == [True, True, False, False]
    assert "Join" not in checked._jdf.queryExecution().executedPlan().toString()


def test_castable(spark):
    data = [("1", "7"), ("2", "x"), ("3", None), ("4", "1.5")]
    got = check(spark, data, [Rule.castable("v", "int")], "id string, v string")
    assert [bool(got[k]._errors) for k in "1234"] == [False, True, False, True]
    data = [("1", "NaN"), ("2", "Infinity"), ("3", "2.5"), ("4", None)]
    got = check(spark, data, [Rule.castable("v", "double")], "id string, v string")
    assert [bool(got[k]._errors) for k in "1234"] == [True, True, False, False]


def test_levels_and_several_failures_in_rule_order(spark):
    rules = [
        Rule.not_null("kind"),
        Rule.expr("low", "price > 5", "!", "warn"),
        Rule.expr("high", "price < 0", "!"),
        Rule.unique(["id"], "warn"),
    ]
    got = check(spark, [("1", None, 1.0)], rules)["1"]
    assert names(got) == ["kind_not_null", "high"]
    assert names(got, "_warnings") == ["low"]


def test_unknown_level_is_refused():
    with pytest.raises(ValueError):
        Rule.not_null("kind", "fatal")


def test_a_later_stage_replaces_earlier_results(spark):
    df = spark.createDataFrame([("1", None, 1.0)], SCHEMA)
    again = quality.apply(quality.apply(df, [Rule.not_null("kind")]), [Rule.not_null("id")])
    assert again.columns == ["id", "kind", "price", "_errors", "_warnings"]
    assert again.first()._errors is None


def test_split_keeps_every_row_once_and_warnings_are_valid(spark):
    data = [(str(i), "x" if i % 3 else None, float(i % 5)) for i in range(60)]
    rules = [Rule.not_null("kind"), Rule.expr("big", "price > 2", "!", "warn")]
    valid, invalid = quality.split(quality.apply(spark.createDataFrame(data, SCHEMA), rules))
    ids = [r.id for r in valid.collect()] + [r.id for r in invalid.collect()]
    assert sorted(ids) == sorted(d[0] for d in data)
    assert valid.where(F.col("_warnings").isNotNull()).count() > 0


def test_reasons_are_disjoint_and_ordered(spark):
    data = [
        (None, "1", "bad"),
        ("a", "1", "bad"),
        ("a", "1", "ok"),
        ("b", "1", "bad"),
        ("c", "1", "ok"),
        (None, "1", "ok"),
    ]
    df = spark.createDataFrame(data, "k string, l string, v string")
    judged = quality.reason_split(df, ["k", "l"], F.col("v") == "bad")
    assert rows(judged, "k", "v", "dq_error_reason") == [
        (None, "bad", "NULL_KEY"),
        (None, "ok", "NULL_KEY"),
        ("a", "bad", "DUPLICATE_KEY"),
        ("a", "ok", "DUPLICATE_KEY"),
        ("b", "bad", "INVALID_FORMAT"),
        ("c", "ok", None),
    ]
