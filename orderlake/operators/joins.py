"""Left joins from a fact or dimension to the rows that describe it.

No side is broadcast by hint: Spark broadcasts one when its measured size is
below its threshold, and otherwise shuffles both and splits skewed partitions of
the fact side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GEO_KEY = "geolocation_key"
# Rows of a lookup of two columns that every task of ``resolve_keys_in_place`` may hold, some 40 MB.
LOOKUP_ROWS = 500_000


def attach_geolocation(
    df: DataFrame, geolocation: DataFrame, zip_code: str, city: str, state: str, one_per_place: bool = False
) -> DataFrame:
    """Add ``geolocation_key`` by zip code, city (any case) and state.

    A place with several coordinates has several keys and multiplies the rows.
    ``one_per_place=True`` takes the smallest key, so the grain of ``df`` holds.
    """
    places = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("_zip"),
        F.lower("geolocation_city").alias("_city"),
        F.col("geolocation_state").alias("_state"),
        GEO_KEY,
    )
    if one_per_place:
        places = places.groupBy("_zip", "_city", "_state").agg(F.min(GEO_KEY).alias(GEO_KEY))
    same_place = (
        (F.col(zip_code) == F.col("_zip"))
        & (F.lower(F.col(city)) == F.col("_city"))
        & (F.col(state) == F.col("_state"))
    )
    return df.join(places, same_place, "left").drop("_zip", "_city", "_state")


def resolve_keys(fact: DataFrame, lookups: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Chain of left joins ``fact -> lookup`` on the named natural key.

    Each lookup should carry only its key and the columns wanted in the fact.
    """
    for lookup, key in lookups:
        fact = fact.join(lookup, key, "left")
    return fact


def resolve_keys_in_place(
    fact: DataFrame, lookups: Iterable[tuple[DataFrame, str, Column | None]], at: str, buckets: int
) -> DataFrame:
    """As ``resolve_keys``, with the rows of the fact left by ``at`` in so many buckets.

    Stored so, they are not shuffled, whatever the size of the lookups: a short one is sent to all
    tasks. A longer one, a frame of its key and one value, is asked with the distinct pairs of
    ``at`` and key, and only those pairs travel. The third part of a lookup is the value that a
    key is known by as a rule, like the hash of a natural key; then no more than the exceptions
    are sent back: keys that are missing, repeated or known by another value. The plan needs
    ``session.IN_PLACE``.
    """
    lookups = list(lookups)
    placed, lost = fact.where(F.col(at).isNotNull()), fact.where(F.col(at).isNull())
    here = placed.repartition(buckets, at)
    for lookup, key, usual in lookups:
        if lookup.count() <= LOOKUP_ROWS:
            here = resolve_keys(here, [(F.broadcast(lookup), key)])
        else:
            here = _answered(here, placed, lookup, key, usual, at, buckets)
    if lost.isEmpty():
        return here
    # rows without a place find no answer that is kept by place
    return here.unionByName(resolve_keys(lost, [(lookup, key) for lookup, key, _ in lookups]))


def _answered(
    here: DataFrame, placed: DataFrame, lookup: DataFrame, key: str, usual: Column | None, at: str, buckets: int
) -> DataFrame:
    (value,) = [c for c in lookup.columns if c != key]
    nothing = F.lit(None).cast(lookup.schema[value].dataType)
    rule = nothing if usual is None else F.when(F.col(key).isNotNull(), usual)
    copies = F.count(F.lit(1)).over(Window.partitionBy(key))
    known = lookup.where(F.col(key).isNotNull()).withColumn("_copies", copies)
    asked = placed.select(at, key).where(F.col(key).isNotNull()).distinct()
    answers = asked.join(known, key, "left").where((F.col("_copies") > 1) | ~F.col(value).eqNullSafe(rule))
    answers = answers.select(at, key, F.col(value).alias("_answer"), F.lit(True).alias("_told")).repartition(buckets, at)
    told = F.when(F.col("_told"), F.col("_answer")).otherwise(rule)
    return here.join(answers, [at, key], "left").select(*here.columns, told.alias(value))
