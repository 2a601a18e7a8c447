"""Declarative row and dataset rules, evaluated as columns.

``apply`` adds ``_errors`` and ``_warnings``: an array of (name, message, columns)
per level, NULL for a clean row. All row rules cost one projection; a uniqueness
rule costs one count per key and one join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators.skew import flag_repeated

ERRORS = "_errors"
WARNINGS = "_warnings"
REASON = "dq_error_reason"
FAILURES = "array<struct<name:string,message:string,columns:array<string>>>"


@dataclass(frozen=True)
class Rule:
    """One check. ``predicate`` is SQL that is true for a row that *fails*; a
    uniqueness rule has none and is decided over the whole dataset."""

    name: str
    level: str
    message: str
    columns: tuple[str, ...] = ()
    predicate: str | None = None
    deduplicated: bool = False

    def __post_init__(self) -> None:
        if self.level not in ("error", "warn"):
            raise ValueError(f"level must be 'error' or 'warn', not {self.level!r}")

    @staticmethod
    def not_null(column: str, level: str = "error", name: str | None = None) -> Rule:
        return Rule(
            name or f"{column}_not_null", level, f"{column} is null", (column,), f"`{column}` IS NULL"
        )

    @staticmethod
    def in_list(column: str, allowed: Sequence[str], level: str = "error", name: str | None = None) -> Rule:
        listed = ", ".join(_quoted(v) for v in allowed)
        return Rule(
            name or f"{column}_valid",
            level,
            f"{column} is null or not in the allowed list",
            (column,),
            f"`{column}` IS NULL OR `{column}` NOT IN ({listed})",
        )

    @staticmethod
    def expr(name: str, condition: str, message: str, level: str = "error") -> Rule:
        """``condition`` must hold. An unknown (NULL) outcome passes."""
        return Rule(name, level, message, (), f"NOT ({condition})")

    @staticmethod
    def castable(column: str, type_name: str, level: str = "error") -> Rule:
        """A present value must convert to ``type_name``; numbers must be finite."""
        cast = f"try_cast(`{column}` AS {type_name})"
        failing = f"`{column}` IS NOT NULL AND {cast} IS NULL"
        if type_name == "double":
            failing += f" OR isnan({cast}) OR abs({cast}) = double('Infinity')"
        return Rule(
            f"{column}_castable", level, f"{column} is not a valid {type_name}", (column,), failing
        )

    @staticmethod
    def unique(
        columns: Sequence[str],
        level: str = "error",
        name: str | None = None,
        deduplicated: bool = False,
    ) -> Rule:
        """Every row of a repeated key fails; a key with a NULL part passes.

        ``deduplicated=True`` promises that the rows come out of a one-row-per-key
        step over some of these columns. Key groups are then tiny and already
        co-located, so the count reuses that shuffle instead of adding one.
        """
        label = "_".join(columns)
        return Rule(
            name or f"{label}_unique",
            level,
            f"{', '.join(columns)} is not unique",
            tuple(columns),
            deduplicated=deduplicated,
        )


def apply(
    df: DataFrame, rules: Sequence[Rule], among: DataFrame | None = None
) -> DataFrame:
    """``df`` with ``_errors`` and ``_warnings``; result columns of an earlier
    stage are replaced. Uniqueness is judged within ``among`` when ``df`` is a part
    of that dataset."""
    checked = df.drop(ERRORS, WARNINGS)
    outcomes: list[tuple[Rule, str]] = []
    flags: list[str] = []
    for rule in rules:
        if rule.predicate is not None:
            outcomes.append((rule, f"coalesce({rule.predicate}, false)"))
            continue
        flag = f"_repeated_{len(flags)}"
        if rule.deduplicated:
            complete = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in rule.columns))
            copies = F.count(F.lit(1)).over(Window.partitionBy(*rule.columns))
            checked = checked.withColumn(flag, complete & (copies > 1))
        else:
            checked = flag_repeated(checked, rule.columns, flag, among=among)
        flags.append(flag)
        outcomes.append((rule, flag))
    judged = checked.withColumns(
        {
            ERRORS: _failures([o for o in outcomes if o[0].level == "error"]),
            WARNINGS: _failures([o for o in outcomes if o[0].level == "warn"]),
        }
    )
    return judged.drop(*flags) if flags else judged


def _failures(outcomes: Sequence[tuple[Rule, str]]) -> Column:
    """Array of the failed rules; arrays are only built for rows that fail."""
    if not outcomes:
        return F.expr(f"CAST(NULL AS {FAILURES})")
    entries = ", ".join(f"CASE WHEN {failed} THEN {_entry(rule)} END" for rule, failed in outcomes)
    any_failed = " OR ".join(failed for _, failed in outcomes)
    return F.expr(f"CASE WHEN {any_failed} THEN CAST(array_compact(array({entries})) AS {FAILURES}) END")


def _entry(rule: Rule) -> str:
    columns = ", ".join(_quoted(c) for c in rule.columns)
    return (
        f"named_struct('name', {_quoted(rule.name)}, 'message', {_quoted(rule.message)}, "
        f"'columns', CAST(array({columns}) AS array<string>))"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). A row with only warnings is valid."""
    return df.where(F.col(ERRORS).isNull()), df.where(F.col(ERRORS).isNotNull())


def failed_names(column: str) -> Column:
    """Names of the failed rules of one level, comma-separated, '' when clean."""
    names = F.transform(F.col(column), lambda failure: failure["name"])
    return F.coalesce(F.array_join(names, ","), F.lit(""))


def reason_split(
    df: DataFrame, keys: Sequence[str], invalid_format: Column
) -> DataFrame:
    """Give each row one reason, or NULL when it is valid.

    The classes are disjoint, the first that applies wins: ``NULL_KEY`` (a key
    column is NULL), ``DUPLICATE_KEY`` (the key occurs again among complete
    keys), ``INVALID_FORMAT`` (``invalid_format`` is true).
    """
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    flagged = flag_repeated(df, keys, "_repeated_key")
    reason = (
        F.when(null_key, "NULL_KEY")
        .when(F.col("_repeated_key"), "DUPLICATE_KEY")
        .when(invalid_format, "INVALID_FORMAT")
    )
    return flagged.withColumn(REASON, reason).drop("_repeated_key")
