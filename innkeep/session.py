"""Session defaults and the shared folder for durable intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark decides broadcasts by size (static or, with AQE, measured) and splits
# skewed shuffle partitions at run time, also where that costs one more shuffle.
# Joins whose measured build partitions are small are hashed instead of sorted.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # HotSpot leaves longer methods uncompiled; Spark then compiles the plan in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "innkeep", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL settings above on a session somebody else created, where they
    can change at run time and concern how Spark plans (not the time zone)."""
    for key, value in DEFAULTS.items():
        if key.startswith(("spark.sql.adaptive.", "spark.sql.codegen.")):
            spark.conf.set(key, value)
    return spark


@contextmanager
def partial_keys(spark: SparkSession) -> Iterator[None]:
    """Inside the block Spark joins tables bucketed by some of the join keys as they lie.
    Plans are made when a query runs, so the block must hold the write."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def open_writers(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Inside the block a task that writes partitions keeps up to ``files`` of them open
    instead of sorting its rows by partition first; with more it sorts from there on."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named in ``spark.checkpoint.dir``.

    Only a local session, which has no other machine to share with, gets a
    folder of its own when the setting is missing."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if context.master.split("[")[0] != "local":  # local-cluster has processes of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="innkeep-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/innkeep/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """The same rows, computed once and stored in the shared folder, so that
    later reads neither recompute them nor depend on any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a table in the shared folder.  Unlike ``durable``, Spark
    then knows the table's size and can decide on a broadcast from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
