"""Spreadsheet extracts: CSV files and raw grids (rows as ``array<string>``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from innkeep.session import stored


def read_sheet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_sheet_checked(
    spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_line"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV with a header row and a declared schema.

    A line with cells that don't parse, too many or too few of them is a reject, with
    the line itself and the reason: which columns don't parse, or its number of cells.
    Nothing turns NULL in silence.  The file is parsed once, permissively, with each
    bad line kept whole; the result is stored, since both halves read it."""
    text = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    every = spark.read.csv(
        path, header=True, schema=text, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt
    )
    held = stored(every, "sheet")
    # the cells of a bad line, all as text, to say what is wrong with it
    width = len(schema.fields)
    cells = F.from_csv(corrupt, ", ".join(f"_{i} string" for i in range(width + 1)), {"mode": "PERMISSIVE"})
    bad = held.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"), cells.alias("c"))
    wrong = [
        F.when(F.col(f"c._{i}").isNotNull() & F.col(f"c._{i}").try_cast(f.dataType).isNull(), F.lit(f.name))
        for i, f in enumerate(schema.fields)
    ]
    unparsed = F.array_join(F.array_compact(F.array(*wrong)), ", ")
    filled = F.size(F.array_compact(F.array(*[F.col(f"c._{i}") for i in range(width + 1)])))
    reason = F.when(F.col(f"c._{width}").isNotNull(), "too many cells").when(
        unparsed != "", F.concat(F.lit("not parsed: "), unparsed)
    )
    rejects = bad.select("line", F.coalesce(reason, F.when(filled < width, "too few cells"), F.lit("malformed")).alias("reason"))
    return held.where(F.col(corrupt).isNull()).drop(corrupt), rejects


def repair_header(names: Sequence[object]) -> list[str]:
    """Trim names, call blank ones ``__col_N`` and number repeats ``name_2``."""
    counts: dict[str, int] = {}
    fixed = []
    for position, raw in enumerate(names, start=1):
        name = str(raw if raw is not None else "").strip() or f"__col_{position}"
        counts[name] = counts.get(name, 0) + 1
        fixed.append(name if counts[name] == 1 else f"{name}_{counts[name]}")
    return fixed


def grid_to_table(df: DataFrame, header: Sequence[str], cells: str = "cells") -> DataFrame:
    """Grid rows as columns: short rows are padded with ``''``, long ones cut.
    Other columns of the grid are kept in front."""
    kept = [F.col(c) for c in df.columns if c != cells]
    width = [
        F.coalesce(F.get(F.coalesce(cells, F.array()), F.lit(i)), F.lit("")).alias(name)
        for i, name in enumerate(header)
    ]
    return df.select(*kept, *width)


def read_grid(df: DataFrame, row_no: str = "row_no", cells: str = "cells") -> DataFrame | None:
    """Grid whose first row is the header, as a table; None for an empty grid.
    The header is the only row brought to the driver."""
    first = df.orderBy(row_no).select(row_no, cells).first()
    if first is None or not first[1]:
        return None
    body = df.where(F.col(row_no) > first[0])
    return grid_to_table(body, repair_header(first[1]), cells)


def grid_ids(df: DataFrame, position: int, cells: str = "cells", alias: str = "id") -> DataFrame:
    """Distinct non-missing values of one grid column."""
    value = F.get(cells, F.lit(position))
    return df.select(value.alias(alias)).where(F.col(alias).isNotNull()).distinct()
