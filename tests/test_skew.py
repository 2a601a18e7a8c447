from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlake.operators.skew import flag_repeated


@pytest.fixture
def lopsided(spark):
    """A third of the rows share one key, a sixth has no key, the rest is mixed."""
    data = [("hot", 1, i) for i in range(400)]
    data += [(None, 1, i) for i in range(200)]
    data += [(f"k{i % 350}", 1, i) for i in range(500)]
    data += [("one", None, 1), ("one", 2, 2)]
    return spark.createDataFrame(data, "a string, b int, n int").repartition(6)


def test_flag_equals_a_plain_count(lopsided):
    got = flag_repeated(lopsided, ["a", "b"], "again").collect()
    data = [tuple(r) for r in lopsided.collect()]
    seen = Counter((a, b) for a, b, _ in data if a is not None and b is not None)
    expected = sorted(map(str, ((a, b, n, seen[(a, b)] > 1) for a, b, n in data)))
    assert sorted(str(tuple(r)) for r in got) == expected


def test_hot_and_missing_keys_are_split_among_tasks(spark):
    """Many hot keys and rows without a key: the executed plan splits their partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("hot"), (F.col("id") % 3).cast("string")))
        df = spark.range(0, 60_000, numPartitions=12).select(key.alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("n"))
        flagged = flag_repeated(df, ["a"], "again")
        assert flagged.where("again").count() == 50_000
        again = flagged.select("a", "again", "n")
        again.collect()
        plan = again._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_columns_keep_their_order(lopsided):
    assert flag_repeated(lopsided, ["b"], "again").columns == ["a", "b", "n", "again"]
