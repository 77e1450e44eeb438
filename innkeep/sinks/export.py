"""Text export for spreadsheets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Fixed value: how dates are shown in exported sheets.
DATE_FORMAT = "dd/MM/yyyy"


def as_text(df: DataFrame, date_cols: Sequence[str]) -> DataFrame:
    """All columns as text: dates formatted, NULL as ``''``."""

    def shown(name: str):
        c = F.col(f"`{name}`")
        text = F.date_format(c, DATE_FORMAT) if name in date_cols else c.cast("string")
        return F.coalesce(text, F.lit("")).alias(name)

    return df.select(*[shown(c) for c in df.columns])


def from_day(df: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """Rows dated ``as_of`` or later."""
    return df.where(F.col(column) >= F.lit(as_of))


def export_text(
    df: DataFrame,
    path: str,
    date_cols: Sequence[str],
    as_of: dt.date | None = None,
    as_of_col: str | None = None,
) -> None:
    """CSV files with a header; with ``as_of`` only rows from that day on."""
    if as_of is not None:
        df = from_day(df, as_of_col or date_cols[0], as_of)
    as_text(df, date_cols).write.mode("overwrite").csv(path, header=True, emptyValue="")
