"""What a silver transformation hands to its sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.quality import Rule
from orderlake.schemas import INGESTED, SOURCE_FILE, UNPARSED

__all__ = ["INGESTED", "SOURCE_FILE", "Pin", "Result", "cast_rules", "casts", "unparsed_rules", "unpinned"]


class Result(NamedTuple):
    """Rows for the table, and the rows each quality gate refused."""

    valid: DataFrame
    source_invalid: DataFrame
    target_invalid: DataFrame | None = None


# Hook for frames several sinks read: a streaming run persists them, a batch
# query leaves them alone.
Pin = Callable[[DataFrame], DataFrame]


def unpinned(df: DataFrame) -> DataFrame:
    return df


def cast_rules(types: Mapping[str, str], strict: bool) -> list[Rule]:
    """Refuse present values that do not convert (they would turn into NULL)."""
    return [Rule.castable(c, t) for c, t in types.items()] if strict else []


def unparsed_rules(batch: DataFrame) -> list[Rule]:
    """Refuse lines that ingest could not fit into the feed's types."""
    if UNPARSED not in batch.columns:
        return []
    return [Rule.expr("line_parsed", f"{UNPARSED} IS NULL", "the line does not fit the feed's types")]


def casts(types: Mapping[str, str], rename: Mapping[str, str] | None = None) -> list[Column]:
    """Tolerant conversions, in order, under their new names."""
    rename = rename or {}
    return [F.col(c).try_cast(t).alias(rename.get(c, c)) for c, t in types.items()]
