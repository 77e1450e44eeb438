"""Column expressions.  Everything here is built from native Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: Column | str) -> Column:
    """A column given as such or by name."""
    return F.col(c) if isinstance(c, str) else c
