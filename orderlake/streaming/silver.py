"""Bronze tables into silver: each micro-batch through its feed's transform."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators import dedup, quality
from orderlake.plans.silver import (
    category_translation,
    geolocation,
    order_items,
    order_payments,
    order_reviews,
    orders,
    people,
    products,
)
from orderlake.plans.silver.result import INGESTED, SOURCE_FILE, Pin, Result
from orderlake.streaming import sinks


@dataclass(frozen=True)
class SilverFeed:
    """How one feed becomes a table. ``key`` names the merge key of dimensions;
    ``changed_only`` keeps rows that change nothing out of their history."""

    table: str
    transform: Callable[..., Result]
    mode: str = "append"
    key: str | None = None
    source_quarantine: str = "invalid"
    target_quarantine: str | None = None
    batch_column: str = sinks.BATCH
    time_column: str = "processed_at"
    row_key: tuple[str, ...] = ()
    changed_only: bool = False
    ingested: str = INGESTED
    not_null: tuple[str, ...] = ()
    bucket_by: str | None = None

    def tables(self, namespace: str) -> list[str]:
        """The table and its quarantines."""
        suffixes = [self.source_quarantine, *([self.target_quarantine] if self.target_quarantine else [])]
        return [f"{namespace}.{self.table}", *(f"{namespace}.{self.table}_{s}" for s in suffixes)]


# Names of the tables and their quarantines.
FEEDS = {
    "customers": SilverFeed(
        "customers",
        partial(people.transform, entity=people.CUSTOMERS),
        "scd2",
        "customer_id",
        "source_invalid",
        "target_invalid",
    ),
    "geolocation": SilverFeed("geolocation", geolocation.transform, row_key=tuple(geolocation.COLUMNS)),
    "order_items": SilverFeed(
        "order_items",
        order_items.transform,
        target_quarantine="invalid_target",
        row_key=("order_id", "order_item_id"),
        not_null=("order_id",),
        bucket_by="order_id",
        ingested=order_items.INGESTED,
    ),
    "order_payments": SilverFeed(
        "order_payments", order_payments.transform, row_key=("order_id", "payment_sequential"),
        not_null=("order_id",),
        bucket_by="order_id"
    ),
    "order_reviews": SilverFeed(
        "order_reviews",
        order_reviews.transform,
        batch_column="dq_batch_id",
        time_column="dq_processed_at",
        row_key=("order_id", "review_id"),
        not_null=("order_id",),
        bucket_by="order_id",
    ),
    "orders": SilverFeed(
        "orders",
        orders.transform,
        source_quarantine="invalid_source",
        target_quarantine="invalid_target",
        row_key=("order_id",),
        not_null=("order_id",),
        bucket_by="order_id",
    ),
    "product_category_translation": SilverFeed(
        "product_category_translation",
        category_translation.transform,
        "scd1",
        category_translation.KEY,
        target_quarantine="invalid_target",
    ),
    "products": SilverFeed("products", products.transform, "scd2", products.KEY, "source_invalid"),
    "sellers": SilverFeed(
        "sellers",
        partial(people.transform, entity=people.SELLERS),
        "scd2",
        "seller_id",
        "source_invalid",
        "target_invalid",
    ),
}


def run_silver(
    spark: SparkSession,
    feed: SilverFeed | str,
    source: str,
    checkpoint: str,
    namespace: str = "silver",
    generation: int | None = None,
    available_now: bool = True,
    files_per_batch: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Process what the bronze table ``source`` gained since the last run.

    The tables are views of a generation's own tables; the run goes on with the generation
    readers see. ``reprocess`` starts the next one. ``buckets`` stores new append tables
    hashed by their feed's ``bucket_by``.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    if generation is None:
        generation = sinks.generation_of(spark, f"{namespace}.{feed.table}") or 0
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(feed, batch, batch_id, namespace, generation, buckets)

    writer = (
        reader.table(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{checkpoint}/generation={generation}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def reprocess(
    spark: SparkSession,
    feed: SilverFeed | str,
    source: str,
    checkpoint: str,
    namespace: str = "silver",
    files_per_batch: int | None = None,
    buckets: int | None = None,
) -> int:
    """Read all of ``source`` again into a new generation and switch to it at the end.

    The next generation has its own checkpoint and tables, so nothing is appended twice and
    readers see the old one until the new one is whole. A call that fails goes on where it
    stopped when it is called again. Returns the generation now shown.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    shown = sinks.generation_of(spark, f"{namespace}.{feed.table}")
    following = 0 if shown is None else shown + 1
    run_silver(
        spark, feed, source, checkpoint, namespace, following, True, files_per_batch, buckets
    ).awaitTermination()
    # the main table last: it tells which generation is shown
    for table in reversed(feed.tables(namespace)):
        if spark.catalog.tableExists(f"{table}_g{following}"):
            sinks.show_generation(spark, table, following)
    return following


def current(spark: SparkSession, feed: SilverFeed | str, namespace: str = "silver") -> DataFrame:
    """Newest row per key over all batches of an append table. Batches are
    deduplicated one by one, so a key delivered again is in the table again."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    rows = spark.table(f"{namespace}.{feed.table}").drop(feed.time_column)
    return dedup.latest(rows, list(feed.row_key), feed.ingested, [feed.batch_column, SOURCE_FILE])


def process_batch(
    feed: SilverFeed,
    batch: DataFrame,
    batch_id: int,
    namespace: str = "silver",
    generation: int = 0,
    buckets: int | None = None,
) -> None:
    """One batch into the table and its quarantines. Safe to run again."""
    spark = batch.sparkSession
    pinned: list[DataFrame] = []
    try:
        # asked whether it is empty, then read by the gates
        batch = _pinning(pinned)(batch)
        if batch.isEmpty():
            return
        _write(feed, feed.transform(batch, pin=_pinning(pinned)), batch_id, namespace, generation, buckets)
    finally:
        for df in pinned:
            df.unpersist()
    for table in feed.tables(namespace):
        if not spark.catalog.tableExists(table):
            sinks.show_generation(spark, table, generation)


def _pinning(pinned: list[DataFrame]) -> Pin:
    """Several sinks read the checked frames; keep them, on disk when too large."""

    def pin(df: DataFrame) -> DataFrame:
        pinned.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    return pin


def _write(
    feed: SilverFeed, result: Result, batch_id: int, namespace: str, generation: int, buckets: int | None
) -> None:
    table = f"{namespace}.{feed.table}"

    def append(df: DataFrame, name: str, **options) -> None:
        stamped = sinks.stamped(df, feed.time_column)
        sinks.append_batch(stamped, f"{name}_g{generation}", batch_id, feed.batch_column, **options)

    refused = result.source_invalid
    if result.target_invalid is not None:
        if feed.target_quarantine:
            append(result.target_invalid, f"{table}_{feed.target_quarantine}")
        else:
            refused = refused.unionByName(result.target_invalid, allowMissingColumns=True)
    append(refused, f"{table}_{feed.source_quarantine}")

    valid = result.valid
    if feed.mode == "append":
        valid = valid.drop(quality.ERRORS, quality.WARNINGS)
        append(valid, table, not_null=feed.not_null, buckets=buckets, bucket_by=feed.bucket_by)
    elif feed.mode == "scd1":
        sinks.merge_upsert(valid, f"{table}_g{generation}", feed.key, batch_id)
    else:
        sinks.merge_versions(valid, f"{table}_g{generation}", feed.key, batch_id, feed.changed_only)
