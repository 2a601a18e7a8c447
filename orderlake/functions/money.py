"""Sums and averages of DOUBLE amounts that lose nothing and do not depend on row order.

Adding doubles gives other last bits whenever tasks finish in another order or are run
again. Here an amount is split without error into four whole numbers, its digits in base
2^21 down to 2^-42, whose sums are exact and cannot overflow for 2^42 rows, and what is
left below 2^-42, which is added as a double like NaN, infinite and huge amounts (2^42 and
more, which have hardly any digits behind the point). So nothing is rounded per row, and
whatever a plain SUM can add is in the sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("high", "low", "tenths", "ends", "odd")
_BITS = 21
_BASE = float(1 << _BITS)
_UNIT = float(1 << 2 * _BITS)


def _upper(whole: Column) -> Column:
    return F.shiftright(whole, _BITS)


def _lower(whole: Column) -> Column:
    return whole.bitwiseAND((1 << _BITS) - 1)


def parts_of(amount: Column) -> tuple[Column, ...]:
    """SUM of ``amount`` as columns, named like ``PARTS``, that can be summed further; NULLs are ignored."""
    fits = F.abs(amount) < _UNIT
    whole = F.when(fits, amount).cast("bigint")
    fraction = (amount - whole) * _UNIT
    digits = fraction.cast("bigint")
    odd = F.when(fits, (fraction - digits) / _UNIT).otherwise(amount)
    return F.sum(_upper(whole)), F.sum(_lower(whole)), F.sum(_upper(digits)), F.sum(_lower(digits)), F.sum(odd)


def from_parts(high: Column, low: Column, tenths: Column, ends: Column, odd: Column) -> Column:
    """The amount that summed parts stand for, NULL if nothing was summed."""
    high, low, tenths, ends = (F.coalesce(c, F.lit(0).cast("bigint")) for c in (high, low, tenths, ends))
    tenths = tenths + _upper(ends)
    low = low + _upper(tenths)
    high = high + _upper(low)
    whole = high.cast("double") * _BASE + _lower(low)
    fraction = (_lower(tenths) * (1 << _BITS) + _lower(ends)).cast("double") / _UNIT
    total = whole + fraction
    # what the addition above rounded off goes with the small rest
    return total + ((fraction - (total - whole)) + odd)


def named_parts(amount: Column, name: str) -> list[Column]:
    """The parts of a sum as columns for a first step of aggregation."""
    return [part.alias(f"{name}_{suffix}") for part, suffix in zip(parts_of(amount), PARTS)]


def sum_of_parts(name: str) -> Column:
    """The sum over rows that hold ``named_parts``: rounded once, not once per step."""
    return from_parts(*[F.sum(f"{name}_{suffix}") for suffix in PARTS])


def exact_sum(amount: Column) -> Column:
    """SUM of ``amount``; NULLs are ignored, NULL for a group without amounts."""
    return from_parts(*parts_of(amount))


def exact_avg(amount: Column) -> Column:
    """Mean of the non-NULL amounts from the exact sum; NULL for an empty group."""
    return F.try_divide(exact_sum(amount), F.count(amount))


# The same as SQL text, for views that are stored as text.


def parts_sql(amount: str, name: str) -> str:
    """``named_parts`` of a column in SQL."""
    fits = f"abs({amount}) < {_UNIT}D"
    whole = f"CAST(CASE WHEN {fits} THEN {amount} END AS BIGINT)"
    digits = f"CAST(({amount} - {whole}) * {_UNIT}D AS BIGINT)"
    odd = f"CASE WHEN {fits} THEN (({amount} - {whole}) * {_UNIT}D - {digits}) / {_UNIT}D ELSE {amount} END"
    terms = [f"shiftright({whole}, {_BITS})", f"{whole} & {(1 << _BITS) - 1}", f"shiftright({digits}, {_BITS})",
             f"{digits} & {(1 << _BITS) - 1}", odd]
    return ", ".join(f"sum({term}) AS {name}_{suffix}" for term, suffix in zip(terms, PARTS))


def total_sql(name: str, of: str = "sum") -> str:
    """The amount that parts stand for, after adding them up with ``of``; '' takes them as they are."""
    high, low, tenths, ends = (f"coalesce({of}({name}_{suffix}), 0L)" for suffix in PARTS[:4])
    tenths = f"({tenths} + shiftright({ends}, {_BITS}))"
    low = f"({low} + shiftright({tenths}, {_BITS}))"
    high = f"({high} + shiftright({low}, {_BITS}))"
    mask = (1 << _BITS) - 1
    whole = f"(CAST({high} AS DOUBLE) * {_BASE}D + ({low} & {mask}))"
    fraction = f"(CAST(({tenths} & {mask}) * {1 << _BITS} + ({ends} & {mask}) AS DOUBLE) / {_UNIT}D)"
    return f"({whole} + {fraction} + (({fraction} - (({whole} + {fraction}) - {whole})) + {of}({name}_odd)))"
