"""Slowly changing dimensions as DataFrame-to-DataFrame functions.

A versioned table has ``EffectiveFrom``, ``EffectiveTo`` and ``IsActive``; a
version is active while its end is NULL. Nothing here reads or writes storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators import dedup

FROM = "EffectiveFrom"
TO = "EffectiveTo"
ACTIVE = "IsActive"


def versions(
    df: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    slice_by: str | None = None,
    open_ended: bool = False,
    keep_ties: bool = False,
) -> DataFrame:
    """Turn change rows into versions: each ends where the key's next one starts.

    Rows of one key with the same start collapse to one (the largest by
    ``tie_breakers``, then by all columns); ``keep_ties=True`` keeps them as
    zero-length versions instead, all but the largest, and wants distinct records.
    ``open_ended=True`` skips the end dates: every row becomes an active version.

    ``slice_by`` ("hour", "day", "month", ...) is for event-time starts, where one
    key may hold a large share of all rows: the look-ahead then runs per key *and*
    slice, see ``_chain``. Without it all versions of a key meet in one task,
    which is fine when starts are ingest times: after the collapse a key has at
    most one version per ingest batch.
    """
    started = df.withColumn(FROM, F.col(ts))
    if open_ended:
        ended = started.withColumn(TO, F.lit(None).cast("timestamp"))
        return ended.select(key, *attributes, FROM, TO, F.lit(True).alias(ACTIVE))
    if keep_ties:
        ended = _end_with_ties(started, key, tie_breakers or attributes, slice_by)
    elif slice_by:
        ended = _chain(started, key, _ties(started, key, tie_breakers), collapse=True, slice_by=slice_by)
    else:
        # the collapse comes first, in the map tasks: a batch of ingest has few starts
        kept = dedup.latest(started, [key, FROM], ts, tie_breakers).select(key, *attributes, FROM)
        ended = _chain(kept, key)
    return ended.select(key, *attributes, FROM, TO, F.col(TO).isNull().alias(ACTIVE))


def _ties(df: DataFrame, key: str, tie_breakers: Sequence[str] | None) -> list[str]:
    first = [c for c in (tie_breakers or ()) if c in df.columns]
    return [*first, *(c for c in df.columns if c not in first and c not in (key, FROM))]


def replay(
    df: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    batch: str,
    tie_breakers: Sequence[str] | None = None,
    slice_by: str | None = None,
    changed_only: bool = False,
) -> DataFrame:
    """The history that merging the batches of ``df`` one after the other gives, in one pass.

    Versions follow one another by ``batch``, then by start; those of one batch and start
    collapse. With ``changed_only`` a version equal to the one before it is left out.
    """
    started = df.withColumn(FROM, F.col(ts))
    ties = [c for c in _ties(started, key, tie_breakers) if c != batch]
    states = attributes if changed_only else None
    ended = _chain(started, key, ties, batch, collapse=True, attributes=states, slice_by=slice_by)
    return ended.select(key, *attributes, FROM, TO, F.col(TO).isNull().alias(ACTIVE))


def _end_with_ties(
    df: DataFrame, key: str, tie_breakers: Sequence[str], slice_by: str | None
) -> DataFrame:
    """Ends when equal starts stay: a row that is not the last of its start ends
    where it begins, the last one where the key's next start is. Only one row per
    key and start, made in the map tasks, takes part in the look-ahead."""
    rank = F.struct(*tie_breakers)
    starts = df.groupBy(key, FROM).agg(F.max(rank).alias("_last"))
    followed = _chain(starts, key, slice_by=slice_by).select(key, FROM, "_last", F.col(TO).alias("_next"))
    joined = df.join(followed, [key, FROM], "left")
    return joined.withColumn(TO, F.when(rank == F.col("_last"), F.col("_next")).otherwise(F.col(FROM)))


def _chain(
    df: DataFrame,
    key: str,
    ties: Sequence[str] = (),
    batch: str | None = None,
    collapse: bool = False,
    attributes: Sequence[str] | None = None,
    known: DataFrame | None = None,
    touched: DataFrame | None = None,
    slice_by: str | None = None,
) -> DataFrame:
    """``TO`` of every row from the start of the key's next one, in the order of
    ``batch``, start and ``ties``; all in one pass.

    ``collapse`` leaves the last row of each start. With ``attributes`` a row equal to
    the one before it (NULL equals NULL) is left out, the first one if it equals
    ``known`` (key, ``_known``); ends then lead to the next row that stays. Keys not in
    ``touched`` (key) keep all rows and their ends, and ``_touched`` tells them apart.

    With ``slice_by`` a key is split by time: windows per (key, slice) settle what does
    not cross the edge of a slice, see ``_across`` for the rest.
    """
    before = [batch] if batch else []
    order = [*before, FROM, *ties]
    unit = F.date_trunc(slice_by, FROM) if slice_by else F.lit(0)
    # a struct is never NULL, so NULL keys are a group like others
    df = df.withColumn("_part", F.struct(F.col(key).alias("_key"), *before, unit.alias("_unit")))
    within = Window.partitionBy("_part").orderBy(*order)
    across = bool(slice_by) or known is not None or touched is not None
    if batch and not across:
        within = Window.partitionBy("_part._key").orderBy(*order)
    rows = df
    if collapse:
        start = F.struct(*before, FROM)
        rows = rows.withColumn("_same", F.lead(start).over(within).eqNullSafe(start)).where(~F.col("_same"))
    if attributes is None:
        rows = rows.withColumn("_next", F.lead(FROM).over(within))
    else:
        state = F.struct(*attributes)
        rows = rows.withColumns({"_state": state, "_before": F.lag(state).over(within), "_ends": F.lead(F.lit(1)).over(within).isNull()})
        rows = rows.withColumn("_stays", ~F.col("_state").eqNullSafe(F.col("_before"))).withColumn(
            "_stays", F.when(F.col("_before").isNotNull(), F.col("_stays"))
        )
        # the next row that stays, as the last one seen from behind: a frame that only grows
        backwards = within.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        seen = F.last(F.when(F.col("_stays"), F.col(FROM)), ignorenulls=True)
        rows = rows.withColumn("_next", seen.over(backwards))
    if across:
        return _across(df if attributes is None else rows, rows, attributes, known, touched, key)
    if attributes is not None:
        rows = rows.where(F.coalesce("_stays", F.lit(True)))
    return rows.withColumn(TO, F.col("_next"))


def _across(
    source: DataFrame,
    rows: DataFrame,
    attributes: Sequence[str] | None,
    known: DataFrame | None,
    touched: DataFrame | None,
    key: str,
) -> DataFrame:
    """What ``_chain`` needs from other slices: the state before a slice's first row and
    the next start after its last. One row per key and slice, aggregated where the
    windows have put the rows, is chained per key and joined back."""
    measures = [F.min(FROM).alias("_opening")]
    if attributes is not None:
        measures += [
            F.first(F.when(F.col("_before").isNull(), F.col("_state")), ignorenulls=True).alias("_first"),
            F.first(F.when(F.col("_ends"), F.col("_state")), ignorenulls=True).alias("_last"),
            F.min(F.when(F.col("_stays"), F.col(FROM))).alias("_inner"),
        ]
    edges = source.groupBy("_part").agg(*measures).withColumn("_key", F.col("_part._key"))
    if known is not None:
        edges = edges.join(known.select(F.col(key).alias("_known_key"), "_known"), F.col("_key") == F.col("_known_key"), "left")
    if touched is not None:
        keys = touched.select(F.col(key).alias("_touched_key")).distinct().withColumn("_touched", F.lit(True))
        edges = edges.join(keys, F.col("_key").eqNullSafe(F.col("_touched_key")), "left")
        edges = edges.withColumn("_touched", F.coalesce("_touched", F.lit(False)))
    forwards = Window.partitionBy("_key").orderBy("_part")
    if attributes is None:
        edges = edges.withColumns({"_opens": F.lit(True), "_after": F.lead("_opening").over(forwards)})
    else:
        state = F.lag("_last").over(forwards)
        state = state if known is None else F.coalesce(state, "_known")
        edges = edges.withColumn("_state_before", state).withColumn(
            "_opens", F.col("_state_before").isNull() | ~F.col("_first").eqNullSafe(F.col("_state_before"))
        )
        opening = F.when(F.col("_opens"), F.col("_opening")).otherwise(F.col("_inner"))
        backwards = Window.partitionBy("_key").orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.withColumn("_after", F.last(opening, ignorenulls=True).over(backwards))
    flags = [] if touched is None else ["_touched"]
    joined = rows.join(edges.select("_part", "_opens", "_after", *flags), "_part", "left")
    stays = F.lit(True) if attributes is None else F.coalesce("_stays", "_opens")
    end = F.coalesce("_next", "_after")
    if touched is None:
        return joined.where(stays).withColumn(TO, end)
    return joined.where(stays | ~F.col("_touched")).withColumn(TO, F.when(F.col("_touched"), end).otherwise(F.col(TO)))


def active(df: DataFrame) -> DataFrame:
    """The current version of each key."""
    return df.where(ACTIVE)


def _first_starts(incoming: DataFrame, key: str) -> DataFrame:
    return incoming.groupBy(key).agg(F.min(FROM).alias("_closed_at"))


def merge_parts(current: DataFrame, incoming: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Merge into the *active* rows only: (newly closed rows, new active rows).

    The active row of a touched key closes at the key's earliest incoming start;
    all incoming versions are added. Closed history is neither read nor written.
    """
    rows = merge_rows(current, incoming, key)
    return rows.where(~F.col(ACTIVE)), rows.where(ACTIVE)


def merge_rows(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Both parts of ``merge_parts`` in one frame, told apart by ``IsActive``: the active rows are
    joined once, and a caller that keeps the frame writes both parts from one pass."""
    starts = _first_starts(incoming, key).withColumn("_touched", F.lit(True))
    touched = F.col("_touched").isNotNull()
    settled = current.join(starts, key, "left").withColumns(
        {TO: F.when(touched, F.col("_closed_at")).otherwise(F.col(TO)), ACTIVE: F.when(touched, False).otherwise(F.col(ACTIVE))}
    )
    return settled.select(current.columns).unionByName(incoming.select(current.columns))


def apply(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The whole table after the merge. Already closed rows pass by unshuffled."""
    history = target.where(~F.coalesce(F.col(ACTIVE), F.lit(False)))
    starts = _first_starts(incoming, key)
    touched = F.col("_closed_at").isNotNull()
    current = active(target).join(starts, key, "left").withColumns(
        {
            TO: F.when(touched, F.col("_closed_at")).otherwise(F.col(TO)),
            ACTIVE: ~touched,
        }
    )
    columns = target.columns
    return (
        history.unionByName(current.select(columns)).unionByName(incoming.select(columns))
    )


def drop_unchanged(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    attributes: Sequence[str],
    slice_by: str | None = None,
) -> DataFrame:
    """Incoming versions that really change something.

    A version is dropped when its attributes equal those of the version before
    it (NULL equals NULL): the key's previous incoming version, or the active row
    for the first one. Ends are recomputed for what is left.
    """
    known = current.select(key, F.struct(*attributes).alias("_known"))
    ended = _chain(incoming, key, [ACTIVE, *attributes], attributes=attributes, known=known, slice_by=slice_by)
    return ended.withColumn(ACTIVE, F.col(TO).isNull()).select(incoming.columns)


def rebuild(
    df: DataFrame,
    key: str,
    touched: DataFrame | None = None,
    slice_by: str | None = None,
    changed_only: bool = False,
) -> DataFrame:
    """Recompute ends and flags from the starts alone, which repairs history after
    versions arrived late. Every row stays: among equal starts all but the last (a
    closed row before an active one, the earlier end, the larger attributes) become
    empty versions. Keys not in ``touched`` keep their rows as they are; with
    ``changed_only`` versions equal to the one before them go."""
    attributes = [c for c in df.columns if c not in (key, FROM, TO, ACTIVE)]
    states = attributes if changed_only else None
    ended = _chain(df, key, [ACTIVE, TO, *attributes], attributes=states, touched=touched, slice_by=slice_by)
    now = F.col(TO).isNull()
    flag = now if touched is None else F.when(F.col("_touched"), now).otherwise(F.col(ACTIVE))
    return ended.withColumn(ACTIVE, flag).select(df.columns)


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Type 1: a source row replaces the target row of its key or is added.

    ``source`` has one row per key and the target's columns.
    """
    return target.join(source, key, "left_anti").unionByName(source.select(target.columns))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    insert_when: Column | None = None,
    match_when: Column | None = None,
) -> DataFrame:
    """General merge: update matched target rows, insert unmatched source rows.

    In ``update`` and ``insert`` source columns are named ``source.<column>`` and
    target columns plainly; target columns missing from ``insert`` become NULL.
    ``match_when`` narrows which target rows can match at all, ``insert_when``
    which unmatched source rows are inserted. It is an error if two source rows
    match the same target row.
    """
    keys = list(on)
    eligible = F.lit(True) if match_when is None else F.coalesce(match_when, F.lit(False))
    packed = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(*source.columns)).alias("source")
    )
    marked = target.withColumn("_eligible", eligible)
    matched = F.col("_eligible") & F.col("_copies").isNotNull()
    clash = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    hit = F.when(matched & (F.col("_copies") > 1), clash).otherwise(matched)
    joined = marked.join(packed, keys, "left").withColumn("_hit", hit)
    updated = joined.select(
        *[
            F.when(F.col("_hit"), update[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in target.columns
        ]
    )
    taken = marked.where("_eligible").select(*keys).distinct()
    fresh = source.join(taken, keys, "left_anti").select(F.struct(*source.columns).alias("source"))
    if insert_when is not None:
        fresh = fresh.where(insert_when)
    inserted = fresh.select(
        *[
            (insert[field.name] if field.name in insert else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in target.schema.fields
        ]
    )
    return updated.unionByName(inserted)
