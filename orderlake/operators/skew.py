"""Marking repeated keys when one key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_repeated(df: DataFrame, keys: Sequence[str], flag: str, among: DataFrame | None = None) -> DataFrame:
    """Add BOOLEAN ``flag``: does the row's key occur more than once?

    Keys are counted in ``df`` itself, or in ``among`` when ``df`` is a part of it. A key
    with a NULL part never counts as repeated.

    Rows are counted per key with a map-side partial aggregate, then the verdict, one row
    per repeated key, is joined back. The rows of a hot key fill a large partition of that
    join, which Spark splits among tasks while it runs (the session's settings make it do
    so in any plan). It does so only if both sides are shuffled for the join alone, so the
    join takes in a column that the counts are not yet partitioned by; for rows without a
    key this column holds the map partition and spreads them.
    """
    complete = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    counted = (df if among is None else among).where(complete).groupBy(*keys)
    repeated = counted.agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    names = [f"_key{i}" for i in range(len(keys))]
    # Always -1, but not a literal: the optimizer would fold a literal into a plain
    # condition and leave it out of the partitioning.
    place = "least(_n, -1L) AS _place"
    lookup = repeated.selectExpr(*[f"`{k}` AS {name}" for k, name in zip(keys, names)], place, "true AS _repeated")
    same_key = " AND ".join(f"`{k}` = {name}" for k, name in zip(keys, names))
    spread = df.withColumn("_spread", F.expr(f"IF({complete}, -1L, CAST(spark_partition_id() AS bigint))"))
    return (
        spread.join(lookup, F.expr(f"{same_key} AND _spread = _place"), "left")
        .withColumn(flag, F.expr("coalesce(_repeated, false)"))
        .drop(*names, "_spread", "_place", "_repeated")
    )
