"""CSV feeds into append-only bronze tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.schemas import FEEDS, Feed
from orderlake.sources.csv import csv_stream, rows_by_header, with_lineage
from orderlake.streaming.sinks import append_batch

USE_FEED_SCHEMA = object()


def run_bronze(
    spark: SparkSession,
    feed: Feed | str,
    source: str,
    table: str,
    checkpoint: str,
    schema=USE_FEED_SCHEMA,
    schema_path: str | None = None,
    available_now: bool = True,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Ingest what has arrived in ``source`` since the last run.

    A line of a typed feed that does not fit its types is kept whole in an extra
    column, for which the silver gate refuses the row.

    ``schema=None`` takes the schema from the files instead of the feed's own:
    typed feeds infer types, the others stay text. The caller waits on the query.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    stream = csv_stream(
        spark,
        source,
        schema=feed.read_schema if schema is USE_FEED_SCHEMA else schema,
        infer_types=feed.typed,
        schema_path=schema_path,
        files_per_batch=files_per_batch,
    )
    writer = (
        with_lineage(stream, feed.ingest_column)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table)


def run_bronze_by_header(
    spark: SparkSession, feed: Feed | str, source: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Ingest files whose columns may come in another order or number.

    Each file is read by its own header and all columns are text; missing ones are NULL,
    columns outside the feed and rows that do not fit their header are kept beside the
    feed's columns, see ``rows_by_header``.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    lines = spark.readStream.text(source).selectExpr(
        "value", "_metadata.file_path AS _file", "_metadata.file_block_start AS _start"
    )

    def ingest(batch, batch_id: int) -> None:
        rows = rows_by_header(batch, feed.schema.names)
        append_batch(rows.withColumn(feed.ingest_column, F.current_timestamp()), table, batch_id)

    return (
        lines.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
