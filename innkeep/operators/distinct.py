"""Distinct counts that can be added up over loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from innkeep.sinks.tables import write_table

#: log2 of a sketch's registers; the standard error is 1.04 / sqrt(2 ** LOG_K).
LOG_K = 12


def standard_error(log_k: int = LOG_K) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (log_k / 2)


def load_sketches(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), log_k: int = LOG_K) -> DataFrame:
    """Per group: a sketch of each column's distinct values, some kilobytes whatever the
    number of rows.  Sketches are filled before the shuffle, one per group and task."""
    return df.groupBy(*groups).agg(*[F.hll_sketch_agg(F.col(c), log_k).alias(c) for c in columns])


def append_sketches(sketches: DataFrame, path: str, load: str) -> None:
    """Store a load's sketches; the same load stored again replaces itself."""
    write_table(sketches, f"{path}/load={load}")


def estimates(stored: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct values over all stored loads, without reading the loads again."""
    united = stored.groupBy(*groups).agg(*[F.hll_union_agg(F.col(c)).alias(c) for c in columns])
    return united.select(*groups, *[F.hll_sketch_estimate(c).alias(c) for c in columns])
