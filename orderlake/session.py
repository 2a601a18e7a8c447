"""Spark session settings the library is written for."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Every setting is a public Spark option. UTC keeps date keys independent of the
# machine; ANSI is Spark 4's default and named here because the cast rules rely
# on it; skew-join splitting is what spreads hot foreign keys in the star joins.
# Tasks are merged to 8 MB of shuffled rows and not to 64, as several sorts of one
# task hold its rows at once, some 30 times that size. Tables stored by bucket are
# read one bucket a task even where no join asks for it: a table written from them
# arrives by bucket too, and its writer sorts one bucket and not a run of files.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}
# Rows stored by one column stay there in a join on it and another one. Spark shuffles them by
# both unless told otherwise, since few values of the one may hold most rows; so this is set for
# plans over tables stored by bucket alone, which are read by bucket anyway.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def build(master: str | None = None, app: str = "orderlake", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots.

    The number of shuffle partitions is left to the cluster (AQE coalesces what
    is too fine); tests pass ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what is planned and run inside."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach, for checkpoints and staged files.

    It is the cluster's own ``spark.checkpoint.dir``. Only in local mode, where
    driver and executors share one disk, may a temporary folder stand in.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="orderlake-")
