"""Deduplication. Each function keeps whole rows and is deterministic.

"Keep one row per key" is written as ``row_number() = 1``: Catalyst places a
group limit before the shuffle, so every map task sends at most one row per key
and a hot key never collects in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.keys import record_hash
from orderlake.operators.skew import flag_repeated


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def _ties(df: DataFrame, used: Sequence[str], tie_breakers: Sequence[str] | None) -> list[Column]:
    """Descending tie-breakers: the given ones first, then every other column."""
    first = [c for c in (tie_breakers or ()) if c in df.columns]
    rest = [c for c in df.columns if c not in first and c not in used]
    return [F.desc(c) for c in [*first, *rest]]


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per key. Rows of one ingest batch share their timestamp, so the
    remaining columns decide ties (``tie_breakers`` first, largest value wins)."""
    ties = _ties(df, [*keys, order_col], tie_breakers)
    return _first_per_key(df, keys, [F.desc(order_col), *ties])


def exact(df: DataFrame, columns: Sequence[str], order_col: str) -> DataFrame:
    """One row per combination of ``columns``: the oldest by ``order_col``."""
    ties = [F.asc(c) for c in df.columns if c not in columns and c != order_col]
    return _first_per_key(df, columns, [F.asc(order_col), *ties])


def by_hash(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    ts: str,
    null_skipping: bool = False,
) -> DataFrame:
    """One row per (key, ts, fingerprint of the attributes)."""
    marked = df.withColumn("_hash", record_hash(*attributes, null_skipping=null_skipping))
    order = _ties(df, [key, ts], None) or [F.asc(key)]
    return _first_per_key(marked, [key, ts, "_hash"], order).drop("_hash")


def any_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key without a rule which; ours is the largest, so runs agree."""
    return _first_per_key(df, keys, _ties(df, keys, None) or [F.asc(k) for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def reject_duplicates(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique, *all* rows of repeated keys)."""
    flagged = flag_repeated(df, keys, "_repeated_key")
    return (
        flagged.where(~F.col("_repeated_key")).drop("_repeated_key"),
        flagged.where("_repeated_key").drop("_repeated_key"),
    )
