"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stage

ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("n"), F.least("a", "m").alias("m")
    )
    return near.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    moved = down.join(least, F.col("a") == F.col("n")).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of integers to (node, root): the smallest node each node reaches.

    Nodes without a link to another node are not returned. Both star operations keep
    components whole, so rounds repeat until the links stay the same; each round is
    written to the shared folder. Long chains halve per round.
    """
    links = stage(links.filter("a <> b").distinct(), "links")
    seen = None
    for _ in range(ROUNDS):
        links = stage(_small_star(_large_star(links).distinct()).distinct(), "links")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
    raise RuntimeError("components did not settle")
