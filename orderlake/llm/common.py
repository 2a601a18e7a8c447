"""Helpers the operators share: tables, staged results, bounded Arrow blocks."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import session

ARROW_ROWS = 1000
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Before a Python stage: send this package to the executors, once per context, and put
    fewer rows in an Arrow batch, as a text may be long (changes the session's setting)."""
    context = spark.sparkContext
    if getattr(context, "_orderlake_sent", None) is None:
        folder = Path(tempfile.mkdtemp(prefix="orderlake-code-"))
        package = Path(__file__).parents[1]
        context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name))
        context._orderlake_sent = folder
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the place all executors share."""
    return f"{session.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> list[Column]:
    """With doc_id these identify a row's content, so rows of one id may differ and
    repeated rows share one result."""
    column = F.col(text)
    return [F.xxhash64(column).alias("_h1"), F.xxhash64(F.lit(7), column).alias("_h2")]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names not yet in the frame, whatever their case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut to about ``limit`` bytes of text; a longer text is a block of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = done = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, done + limit - size, side="right"))
            if stop <= start and not held:
                stop = start + 1
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - done
                done, start = int(ends[stop - 1]), stop
            if start < batch.num_rows or size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
