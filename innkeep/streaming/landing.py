"""Landed documents as a stream.

Each run takes the files that arrived since the last one, applies the same
operator as the batch marts and appends the rows exactly once.  The checkpoint
remembers what is done, which replaces comparing with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from innkeep.operators.rows import first_by
from innkeep.plans.reservations import reservation_price_days
from innkeep.session import stored
from innkeep.sinks.tables import read_if_exists


def stream_documents(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """New response files below ``path`` as ``(file, landed_at, body)``: one row
    per file, or per line where files hold a response per line."""
    return spark.readStream.text(path, wholetext=whole_files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("landed_at"),
        F.col("value").alias("body"),
    )


def append_new(
    docs: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> StreamingQuery:
    """Start a run over everything new; it ends when that is done."""
    return (
        transform(docs)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )


def once_within(docs: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Documents without those that repeat a key within ``delay`` of its first arrival.
    State is kept that long only, so it doesn't grow with the stream."""
    return docs.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def replace_days(
    rows: DataFrame, day: str, keys: Sequence[str], latest: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Start a run that merges new rows into a table partitioned by ``day``.

    Each batch rewrites only the days it has rows of: their stored rows and the new
    ones, of each of ``keys`` the one with the largest ``latest`` (NULL last; among equals
    the largest row by its other columns).  The result of a batch depends on what it holds and not on how
    often it ran, so a batch repeated after a failure changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = stored(batch, "stream-batch")
        if new.isEmpty():
            return
        old = read_if_exists(spark, table)
        if old is not None:
            days = new.select(day).distinct()
            new = new.unionByName(old.join(days, day, "left_semi").select(*new.columns))
        others = [c for c in new.columns if c not in (*keys, day, latest)]
        order = [F.desc(latest), *[F.desc(c) for c in sorted(others)]]
        merged = stored(first_by(new, [day, *keys], order), "stream-days")
        # a day's rows in few files, a day with very many of them in several tasks
        writer = merged.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(day).parquet(table)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_price_days(docs: DataFrame, manager: Column, table: str, checkpoint: str) -> StreamingQuery:
    """Append the nightly prices of new documents, dated by their arrival."""

    def prices(new: DataFrame) -> DataFrame:
        return reservation_price_days(new, F.col("landed_at"), manager)

    return append_new(docs, prices, table, checkpoint)
