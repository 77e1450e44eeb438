"""Load checks and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from innkeep.functions.numbers import MONEY, drifts_within, grew_within
from innkeep.operators.columns import same_columns

# Text widths used for stored columns.
TEXT_WIDTHS = (255, 1024, 4096)


def quality_gate(
    new: DataFrame,
    base: DataFrame,
    sum_col: str,
    max_growth: float = 0.05,
    max_drift: float = 0.10,
    bootstrap: bool = False,
) -> DataFrame:
    """One row of checks of a load against the published table: same columns,
    row growth within 0..max_growth, sum drift within max_drift.

    Both tables are read once, in one job.  With an empty base the gate only
    accepts an empty load, unless ``bootstrap`` allows the first one."""

    def side(df: DataFrame, name: str) -> DataFrame:
        has = sum_col in df.columns
        amount = F.col(sum_col).try_cast(MONEY) if has else F.lit(0).cast(MONEY)
        return df.select(F.lit(name).alias("side"), amount.alias("amount"))

    def of(name: str, value):
        return F.when(F.col("side") == name, value)

    both = side(new, "new").unionByName(side(base, "base"))
    zero = F.lit(0).cast("decimal(28,2)")
    totals = both.agg(
        F.count(of("new", 1)).alias("new_rows"),
        F.count(of("base", 1)).alias("base_rows"),
        F.coalesce(F.sum(of("new", F.col("amount"))), zero).alias("new_sum"),
        F.coalesce(F.sum(of("base", F.col("amount"))), zero).alias("base_sum"),
    )
    return judged(totals, same_columns(new, base), max_growth, max_drift, bootstrap)


def judged(
    totals: DataFrame,
    columns_ok: bool,
    max_growth: float = 0.05,
    max_drift: float = 0.10,
    bootstrap: bool = False,
) -> DataFrame:
    """The checks of ``quality_gate`` on measures already taken (``new_rows``,
    ``base_rows``, ``new_sum``, ``base_sum``)."""
    first_load = F.lit(bootstrap) & (F.col("base_rows") == 0)
    checked = totals.withColumns(
        {
            "columns_ok": F.lit(columns_ok),
            "rows_ok": first_load | grew_within(F.col("new_rows"), F.col("base_rows"), max_growth),
            "sum_ok": first_load | drifts_within(F.col("new_sum"), F.col("base_sum"), max_drift),
        }
    )
    return checked.withColumn("passed", F.col("columns_ok") & F.col("rows_ok") & F.col("sum_ok"))


def gate_passed(gate: DataFrame) -> bool:
    """The verdict of a one-row gate."""
    return bool(gate.select("passed").first()[0])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def has_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``keys`` identify every row and are never NULL."""
    missing = df.where(" or ".join(f"`{k}` is null" for k in keys))
    return missing.isEmpty() and duplicate_keys(df, keys).isEmpty()


def column_profile(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Per column: type, row and null counts, longest text, suggested width.
    One aggregation over the table, then one row per column."""
    columns = [c for c in df.columns if c not in groups]
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`").cast("string")
        aggregates += [
            F.count(f"`{c}`").alias(f"_c{i}"),
            F.max(F.length(text)).cast("bigint").alias(f"_l{i}"),
        ]
    wide = df.groupBy(*groups).agg(*aggregates)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(_logical_type(df.schema[c].dataType)).alias("logical_type"),
            F.col("_n").alias("n_rows"),
            (F.col("_n") - F.col(f"_c{i}")).alias("n_nulls"),
            F.coalesce(F.col(f"_l{i}"), F.lit(0).cast("bigint")).alias("max_length"),
        )
        for i, c in enumerate(columns)
    ]
    long = wide.select(*groups, F.inline(F.array(*rows)))
    return long.withColumn(
        "storage_type",
        F.when(F.col("logical_type") == "text", text_storage("max_length")).otherwise(
            F.upper("logical_type")
        ),
    )


def text_storage(length: str):
    out = F.when(F.lit(False), F.lit(""))
    for width in TEXT_WIDTHS:
        out = out.when(F.col(length) <= width, f"VARCHAR({width})")
    return out.otherwise("MEDIUMTEXT")


def _logical_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, T.BooleanType):
        return "tinyint(1)"
    if isinstance(kind, T.DecimalType):
        return kind.simpleString()
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.FractionalType):
        return "double"
    return "text"
