"""Gap-free row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from innkeep.functions.text import non_blank
from innkeep.session import durable

# monotonically_increasing_id puts the partition number above these bits.
_ROW_BITS = 33


def last_filled_row(target: DataFrame, row_no: str, text: str) -> int:
    """Number of the last row whose text is not blank, 0 for none."""
    last = target.where(non_blank(text)).agg(F.max(row_no)).first()[0]
    return int(last or 0)


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], start: int = 1, alias: str = "row_no"
) -> DataFrame:
    """Number rows ``start, start+1, …`` in ``order_by`` order.

    The range-partitioned sort is stored once; a row's number is the count of
    rows in earlier partitions plus its place in its own.  Only the partition
    counts, one per task, are brought together."""
    placed = durable(df.orderBy(*order_by)).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", _ROW_BITS)
    counts = sorted(placed.groupBy(part.alias("p")).count().collect())
    offsets, total = [], start
    for p, n in counts:
        offsets.append((p, total))
        total += n
    if not offsets:
        return placed.withColumn(alias, F.lit(start).cast("bigint")).drop("_id")
    first_in_part = df.sparkSession.createDataFrame(offsets, "_p bigint, _first bigint")
    place = F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(first_in_part), part == F.col("_p"))
        .withColumn(alias, F.col("_first") + place)
        .drop("_id", "_p", "_first")
    )


def number_after(
    df: DataFrame,
    target: DataFrame,
    row_no: str,
    text: str,
    order_by: Sequence[Column | str],
) -> DataFrame:
    """Number rows to follow the last filled row of ``target``."""
    return number_rows(df, order_by, last_filled_row(target, row_no, text) + 1, row_no)
