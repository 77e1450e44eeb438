"""Stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Parquet table, pruned and filtered at the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*columns)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Database table read in ``partitions`` ranges of a numeric key; needs the
    database's driver on the class path."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower)
        .options(upperBound=upper, numPartitions=partitions, **options)
        .load()
    )


def counts_for_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """Row count of the table and of one day."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(column).cast("date") == F.lit(day).cast("date")).alias("n_day"),
    )
