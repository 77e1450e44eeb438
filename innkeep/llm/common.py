"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.session import scratch_path

#: A word: a run of characters other than ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a missing doc_id where ids are ordered; sorts after all others.
NO_ID = 2**63 - 1
#: Equal rows beyond this number are numbered in blocks, by several tasks.
COPIES_PER_BLOCK = 4096
#: A side of a join is broadcast up to this many narrow rows (about 32 MB).
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in small batches, so that long ones fit in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def numbered_copies(rows: DataFrame, *columns: str) -> DataFrame:
    """The given columns and ``copy``: 0, 1, … among rows equal in all of them.

    Equal rows are counted before the shuffle and listed again from the count, so
    any number of them is spread over tasks and the numbers never change on a retry."""
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies_"))
    few = counted.where(F.col("copies_") <= COPIES_PER_BLOCK).withColumn("block_", F.lit(0).cast("long"))
    many = (
        counted.where(F.col("copies_") > COPIES_PER_BLOCK)
        .withColumn("block_", F.explode(F.expr(f"sequence(0L, (copies_ - 1) div {COPIES_PER_BLOCK})")))
        .repartition(*columns, "block_")
    )
    last = f"least(copies_, (block_ + 1) * {COPIES_PER_BLOCK}) - 1"
    listed = few.unionByName(many).withColumn("copy", F.explode(F.expr(f"sequence(block_ * {COPIES_PER_BLOCK}, {last})")))
    return listed.select(*columns, "copy")


def id_text(key: str) -> Column:
    """The id as text for hashing; a missing id is the empty text."""
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def hash_bits(text: Column, digits: int) -> Column:
    """The first ``digits`` hex digits (15 at most) of the text's md5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def maybe_broadcast(small: DataFrame, rows: int) -> DataFrame:
    """``small`` marked for broadcast if its counted ``rows`` fit, else left to Spark."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``packed`` writes inside the block go when it ends: what is still
    needed must have been stored elsewhere by then."""
    folder = scratch_path(spark, "run")
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        release(spark)


def run_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the ``scratch`` block, or in the shared folder."""
    folder = _RUN.get()
    return f"{folder}/{name}-{uuid4().hex}" if folder else scratch_path(spark, name)


def packed(df: DataFrame, name: str) -> DataFrame:
    """As ``innkeep.session.stored``, for tables of many hashes: packed more densely, and
    removed with the ``scratch`` block it is in."""
    path = run_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are stored: it does so
    when the driver's garbage collectors find that nothing refers to them any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
