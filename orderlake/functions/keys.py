"""Key expressions: calendar keys, hash surrogate keys, attribute fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator between attributes in a fingerprint.
SEPARATOR = "||"
# Stands for NULL inside a fingerprint; cannot occur in CSV text.
NULL_MARK = "\u0000"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts: Column | str) -> Column:
    """yyyyMMdd of a timestamp as INT, NULL for NULL.

    Built from integer arithmetic: no string is formatted or parsed per row.
    """
    c = _column(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def surrogate_key(*columns: Column | str) -> Column:
    """64-bit hash over the natural key; a NULL part counts as the empty string."""
    return F.xxhash64(*[F.coalesce(_column(c).cast("string"), F.lit("")) for c in columns])


def record_hash(*columns: str, null_skipping: bool = False) -> Column:
    """SHA-256 over the attributes, used to recognise equal records.

    By default NULL has its own mark, so ``(a, NULL, b)`` and ``(a, b, NULL)``
    differ. ``null_skipping=True`` leaves NULLs out, which makes the two collide.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if not null_skipping:
        parts = [F.coalesce(p, F.lit(NULL_MARK)) for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
