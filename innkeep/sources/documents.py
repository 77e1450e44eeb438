"""Landed API responses: one file per response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from innkeep import schemas
from innkeep.operators.rows import union_ragged
from innkeep.operators.columns import keep_present


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Response files as ``(file, body)``.  A response is bounded by the API's
    page size, so one file is one row."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")
    )


def page_reservations(pages: DataFrame, body: str, page: Column | str) -> DataFrame:
    """Reservations of all pages, each with its place ``(page, pos)``.  Records
    sit under ``data.reservations`` or ``reservations``; empty pages give none."""
    # parsed in a step of its own: a generator would parse at every mention
    page = F.col(page) if isinstance(page, str) else page
    parsed = pages.select(page.alias("page"), F.from_json(body, schemas.RESERVATION_PAGE).alias("_d"))
    nested = F.col("_d.data.reservations")
    records = F.coalesce(F.when(F.size(nested) > 0, nested), F.col("_d.reservations"))
    return parsed.select("page", F.posexplode(records).alias("pos", "r")).select("r.*", "page", "pos")


def union_existing(frames: Sequence[DataFrame], wanted: Sequence[str]) -> DataFrame:
    """Lists fetched separately as one table of the wanted columns, without
    repeated rows."""
    return union_ragged([keep_present(df, wanted) for df in frames]).distinct()


def read_json_lists(
    spark: SparkSession, paths: Sequence[str], schema: str
) -> DataFrame:
    """Several landed folders read with one schema in one scan."""
    return spark.read.schema(schema).json(list(paths), multiLine=True)
