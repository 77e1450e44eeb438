"""Daily snapshot tables, partitioned by ``extraction_day``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from innkeep.operators.rows import first_by
from innkeep.sinks.tables import read_if_exists

DAY = "extraction_day"


def snapshot_replace(df: DataFrame, path: str, day: dt.date) -> None:
    """Write ``day``'s snapshot, replacing that day's rows only.  An empty frame
    writes nothing."""
    (
        df.withColumn(DAY, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def snapshot_if_absent(
    df: DataFrame, path: str, day: dt.date, keys: Sequence[str], ordinal: Sequence[str]
) -> bool:
    """Append ``day``'s snapshot unless it has rows already; returns whether it
    was written.  Of rows with the same key the first in ``ordinal`` order stays."""
    existing = read_if_exists(df.sparkSession, path)
    if existing is not None and not existing.where(F.col(DAY) == F.lit(day)).isEmpty():
        return False
    rows = first_by(df, keys, ordinal).withColumn(DAY, F.lit(day))
    rows.write.mode("append").partitionBy(DAY).parquet(path)
    return True
