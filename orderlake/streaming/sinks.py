"""Writing tables so that running a batch again changes nothing, and readers never see half a write.

``foreachBatch`` may call a batch twice. Appends therefore overwrite the partition of
their batch. Whatever is replaced or merged is written beside what readers see, and a
view is switched to it last:

* derived tables (``write_table``) as a whole, as ``<table>_p<n>``;
* merged tables (``merge_versions``, ``merge_upsert``) by bucket of the key's hash, as
  partitions (version, bucket) of ``<table>_active`` and ``<table>_history``. A batch writes
  only the buckets it touches; ``<table>_map`` tells for each batch which version holds a
  bucket, and the view reads what one batch of the map names.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake import session
from orderlake.operators import scd
from orderlake.schemas import INGESTED

BATCH = "batch_id"
BUCKET, VERSION = "bucket", "version"
BUCKETS = 16  # of a merged table when it is created; raise it for tables beyond some tens of GB
ROWS_PER_BUCKET, LEAST_BUCKETS = 250_000, 8  # of derived tables that are stored hashed
REQUIRED = "required"
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition: str | None = None,
    buckets: int | None = None,
    bucket_by: str | None = None,
) -> None:
    """Create the Parquet table if it is absent.

    Columns of ``schema`` that are not nullable are NOT NULL. Spark's catalog drops that for
    Parquet, so it is kept as a table property, which ``required`` enforces at the writer.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if partition:
        columns += f", `{partition}` BIGINT"
    partitioned = f" PARTITIONED BY (`{partition}`)" if partition else ""
    clustered = f" CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {buckets} BUCKETS" if buckets and bucket_by else ""
    needed = ",".join(f.name for f in schema.fields if not f.nullable)
    properties = f" TBLPROPERTIES ('{REQUIRED}' = '{needed}')" if needed else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{partitioned}{clustered}{properties}")


def declared(schema: StructType, columns: list[str] | tuple[str, ...]) -> StructType:
    """The schema with ``columns`` NOT NULL."""
    return StructType([type(f)(f.name, f.dataType, f.nullable and f.name not in columns) for f in schema.fields])


def required(df: DataFrame, table: str) -> DataFrame:
    """Rows on their way into ``table``: a NULL in a NOT NULL column fails the write. The
    columns leave as not nullable; reading a table back through this restores that too."""
    names = _properties(df.sparkSession, table).get(REQUIRED)
    for name in names.split(",") if names else ():
        kind = df.schema[name].dataType
        wrong = F.raise_error(F.lit(f"NULL in column {name} of {table}, which is NOT NULL")).cast(kind)
        # the last value is never reached; it tells Spark that no NULL can come out
        df = df.withColumn(name, F.coalesce(F.col(name), wrong, _some(kind)))
    return df


def _some(kind) -> Column:
    text = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "boolean": "false"}
    return F.lit(text.get(kind.simpleString(), "0")).cast(kind)


def truncate(spark: SparkSession, table: str) -> None:
    """Maintenance only; no pipeline calls it. Empties whatever this module shows as ``table``."""
    known = _properties(spark, table)
    if "generation" in known:
        truncate(spark, f"{table}_g{known['generation']}")
    elif "buckets" in known:
        for part in ("active", "history"):
            if spark.catalog.tableExists(f"{table}_{part}"):
                spark.sql(f"TRUNCATE TABLE {table}_{part}")
    elif VERSION in known:
        spark.sql(f"TRUNCATE TABLE {table}_p{known[VERSION]}")
    else:
        spark.sql(f"TRUNCATE TABLE {table}")


def append_batch(
    df: DataFrame,
    table: str,
    batch_id: int,
    batch_column: str = BATCH,
    not_null: tuple[str, ...] = (),
    buckets: int | None = None,
    bucket_by: str | None = None,
) -> None:
    """Append the rows of one batch; a second run of the batch replaces them.

    A new table gets ``not_null`` columns, and with ``buckets`` each batch is stored hashed and
    sorted by ``bucket_by``, so that joins on it skip a shuffle."""
    spark = df.sparkSession
    rows = df.drop(batch_column)
    ensure_table(spark, table, declared(rows.schema, not_null), batch_column, buckets, bucket_by)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (`{batch_column}` = {batch_id}) BY NAME "
        "SELECT * FROM {rows}",
        rows=required(rows, table),
    )


quarantine = append_batch


def write_table(
    df: DataFrame, table: str, buckets: int | None = None, bucket_by: str | None = None
) -> None:
    """Replace a derived table: written as ``<table>_p<n>``, then the view ``table`` is switched.
    The previous one stays for readers under way. With ``buckets`` it is stored hashed and
    sorted by ``bucket_by``, and later joins on that column skip its shuffle. The files of the
    write's own shuffles go when it ends, and not with the driver's garbage."""
    spark = df.sparkSession
    known = _properties(spark, table)
    if spark.catalog.tableExists(table) and VERSION not in known:
        raise ValueError(f"{table} exists and is not a view of this writer")
    base = _number(known.get(VERSION))
    version = 0 if base is None else base + 1
    if buckets and bucket_by:
        # rows arrive by bucket, so that a bucket is one file and not one for each task
        writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    else:
        writer = df.write
    writer = writer.mode("overwrite").format("parquet").option("compression", "zstd")
    with session.using(spark, TIDY):
        version = _save(writer, table, version)
    _switch(spark, table, version, base, f"SELECT * FROM {table}_p{version}")
    outdated = _number(known.get("previous"))
    if outdated is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}_p{outdated}")


def _save(writer: DataFrameWriter, table: str, version: int) -> int:
    """Save as ``<table>_p<version>``, or the next number whose folder no failed write has left
    files in: its last tasks may write after Spark has cleared it."""
    while True:
        try:
            writer.saveAsTable(f"{table}_p{version}")
            return version
        except PySparkException as error:
            if error.getCondition() != "LOCATION_ALREADY_EXISTS":
                raise
            version += 1


def bucket_count(*tables: DataFrame) -> int:
    """Buckets for derived tables that are joined with each other. A task of such a join holds one
    bucket, so the number follows the rows of the longest table and the bucket's size stays."""
    rows = max(table.count() for table in tables)
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def merge_versions(
    incoming: DataFrame,
    table: str,
    key: str,
    batch_id: int,
    changed_only: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Type 2 merge of one batch of versions into ``table``; with ``changed_only``
    a version equal to the one before it is left out.

    The active rows of the touched buckets are read and written again; newly closed rows are
    added to the history. Only where a version arrives late, that is starts before the active
    one of its key, the history of its bucket is read, rebuilt by start and written again.
    """
    merge = _Merge(incoming, table, key, batch_id, buckets)
    columns = incoming.columns
    try:
        current, touched = merge.current(), merge.touched
        late = merge.late(current)
        prompt = ~F.col(BUCKET).isin(late) if late else F.lit(True)
        fresh, live = merge.incoming.where(prompt), current.where(prompt)
        if changed_only:
            bookkeeping = {key, scd.FROM, scd.TO, scd.ACTIVE, INGESTED, BUCKET}
            attributes = [c for c in columns if c not in bookkeeping]
            fresh = scd.drop_unchanged(live, fresh, key, attributes)
        rows = scd.merge_rows(live, fresh, key).select(columns)
        if late:
            rows = rows.unionByName(merge.rebuilt(current, late, changed_only).select(columns))
        # merged once, written to two tables
        merge.hold(rows)
        merge.write(rows.where(~F.col(scd.ACTIVE)), "history")
        merge.write(rows.where(scd.ACTIVE), "active")
        merge.publish(touched, late, history=True)
    finally:
        merge.release()


def merge_upsert(incoming: DataFrame, table: str, key: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Type 1 merge of one batch (one row per key) into ``table``, by touched buckets."""
    merge = _Merge(incoming, table, key, batch_id, buckets)
    try:
        whole = scd.upsert(merge.current(), merge.incoming, key).select(incoming.columns)
        merge.write(whole, "active")
        merge.publish(merge.touched, [], history=False)
    finally:
        merge.release()


class _Merge:
    """One batch on its way into a merged table, see the module."""

    def __init__(self, incoming: DataFrame, table: str, key: str, batch_id: int, buckets: int) -> None:
        self.spark, self.table, self.key, self.batch_id = incoming.sparkSession, table, key, batch_id
        self.columns, self.schema = incoming.columns, incoming.schema
        known = _properties(self.spark, table)
        self.buckets = _number(known.get("buckets")) or buckets
        self.base = _base_version(self.spark, table, batch_id)
        # read several times below; one pass over the source
        self.held: list[DataFrame] = []
        self.incoming = self.hold(incoming.withColumn(BUCKET, self._bucket()))
        self.touched = sorted(r[0] for r in self.incoming.select(BUCKET).distinct().collect())
        self.map = self._map(self.base)

    def hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def release(self) -> None:
        for df in self.held:
            df.unpersist()

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _map(self, batch_id: int | None) -> dict[int, tuple[int, int]]:
        """Bucket to (version of its active rows, first version of its history); one entry a bucket."""
        if batch_id is None:
            return {}
        rows = self.spark.table(f"{self.table}_map").where(F.col(BATCH) == batch_id).collect()
        return {r[BUCKET]: (r["active"], r["since"]) for r in rows}

    def _read(self, part: str, of: Column) -> DataFrame:
        """Rows of a part with their bucket; ``of`` names partitions only."""
        name = f"{self.table}_{part}"
        if not self.spark.catalog.tableExists(name):
            return self.spark.createDataFrame([], self.schema).withColumn(BUCKET, F.lit(0))
        return self.spark.table(name).where(of).select(*self.columns, BUCKET)

    def current(self) -> DataFrame:
        """Active rows of the touched buckets before this batch."""
        held: dict[int, list[int]] = {}
        for bucket in self.touched:
            if bucket in self.map:
                held.setdefault(self.map[bucket][0], []).append(bucket)
        of = F.lit(False)
        for version, buckets in held.items():
            of = of | ((F.col(VERSION) == version) & F.col(BUCKET).isin(buckets))
        return self._read("active", of)

    def late(self, current: DataFrame) -> list[int]:
        """Buckets in which a version starts before the active one of its key."""
        if not self.map:
            return []
        starts = self.incoming.groupBy(self.key).agg(F.min(scd.FROM).alias("_first"))
        late = current.join(starts, self.key).where(F.col("_first") < F.col(scd.FROM))
        return sorted(r[0] for r in late.select(BUCKET).distinct().collect())

    def rebuilt(self, current: DataFrame, late: list[int], changed_only: bool) -> DataFrame:
        """All versions of the late buckets, those of incoming keys chained anew by start."""
        of = F.lit(False)
        for bucket in late:
            of = of | ((F.col(BUCKET) == bucket) & F.col(VERSION).between(self.map[bucket][1], self.base))
        here = F.col(BUCKET).isin(late)
        arrived = self.incoming.where(here)
        whole = self._read("history", of).unionByName(current.where(here)).unionByName(arrived)
        return scd.rebuild(whole.select(self.columns), self.key, arrived, changed_only=changed_only)

    def write(self, df: DataFrame, part: str) -> None:
        """The rows as this batch's version of their buckets; a second run replaces these partitions.
        Only they are overwritten, so the other versions of the table can be read meanwhile."""
        name = f"{self.table}_{part}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {VERSION} BIGINT, {BUCKET} INT) USING parquet "
            f"PARTITIONED BY ({VERSION}, {BUCKET})"
        )
        rows = df.withColumns({VERSION: F.lit(self.batch_id).cast("bigint"), BUCKET: self._bucket()})
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            rows.hint("rebalance", VERSION, BUCKET).write.insertInto(name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def publish(self, touched: list[int], late: list[int], history: bool) -> None:
        """Write the map of this batch, switch the view to it, drop what neither it nor the base needs."""
        now = dict(self.map)
        for bucket in touched:
            since = self.batch_id if bucket in late or bucket not in now else now[bucket][1]
            now[bucket] = (self.batch_id, since)
        rows = [(bucket, active, since) for bucket, (active, since) in now.items()]
        append_batch(
            self.spark.createDataFrame(rows, f"{BUCKET} int, active bigint, since bigint"), f"{self.table}_map", self.batch_id
        )
        before = _properties(self.spark, self.table)
        columns = ", ".join(f"t.`{c}`" for c in self.columns)
        named = f"(SELECT * FROM {self.table}_map WHERE {BATCH} = {self.batch_id}) m"
        query = (
            f"SELECT /*+ BROADCAST(m) */ {columns} FROM {self.table}_active t JOIN {named} "
            f"ON t.{BUCKET} = m.{BUCKET} AND t.{VERSION} = m.active"
        )
        if history:
            query += (
                f" UNION ALL SELECT /*+ BROADCAST(m) */ {columns} FROM {self.table}_history t JOIN {named} "
                f"ON t.{BUCKET} = m.{BUCKET} AND t.{VERSION} >= m.since WHERE t.{VERSION} <= {self.batch_id}"
            )
        _switch(self.spark, self.table, self.batch_id, self.base, query, {"buckets": str(self.buckets)})
        outdated = _number(before.get("previous"))
        if outdated is not None and outdated != self.base:
            self._prune(outdated, now)

    def _prune(self, outdated: int, now: dict[int, tuple[int, int]]) -> None:
        """Drop the buckets that only the outdated map names."""
        for bucket, (active, since) in self._map(outdated).items():
            keep = [m[bucket] for m in (self.map, now) if bucket in m]
            if active not in [k[0] for k in keep]:
                self._drop("active", active, bucket)
            first = min(k[1] for k in keep)
            if first > since:
                for row in self.spark.sql(f"SHOW PARTITIONS {self.table}_history").collect():
                    held = dict(part.split("=") for part in row[0].split("/"))
                    if held[BUCKET] == str(bucket) and int(held[VERSION]) < first:
                        self._drop("history", int(held[VERSION]), bucket)
        self.spark.sql(f"ALTER TABLE {self.table}_map DROP IF EXISTS PARTITION ({BATCH} = {outdated})")

    def _drop(self, part: str, version: int, bucket: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.table}_{part} DROP IF EXISTS PARTITION ({VERSION} = {version}, {BUCKET} = {bucket})")


def generation_of(spark: SparkSession, table: str) -> int | None:
    """The generation that readers of ``table`` see."""
    return _number(_properties(spark, table).get("generation"))


def show_generation(spark: SparkSession, table: str, generation: int) -> None:
    """Point ``table`` at ``<table>_g<generation>``."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('generation' = '{generation}') "
        f"AS SELECT * FROM {table}_g{generation}"
    )


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    if not spark.catalog.tableExists(table):
        return {}
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _base_version(spark: SparkSession, table: str, batch_id: int) -> int | None:
    """The version to merge into: the view's own, or, if this batch already
    switched the view and runs again, the one before."""
    known = _properties(spark, table)
    current = _number(known.get(VERSION))
    return _number(known.get("previous")) if current == batch_id else current


def _switch(
    spark: SparkSession, table: str, version: int, base: int | None, query: str, more: dict[str, str] | None = None
) -> None:
    """Point the view at the new version; it remembers the one before for a repeated batch."""
    properties = {VERSION: str(version), "previous": "" if base is None else str(base), **(more or {})}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({listed}) AS {query}")


def stamped(df: DataFrame, column: str = "processed_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())
