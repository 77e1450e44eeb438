"""Column-list operators: rename, conform, clean names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# Column names that stand for "no name".
NULL_NAMES = frozenset({"nan", "None", "", "NaN", "NAN"})


def map_columns(df: DataFrame, mapping: Mapping[str, str | None], fill: str = "") -> DataFrame:
    """Select ``target: source`` pairs; a missing source gives ``fill``."""
    return df.select(
        *[
            (F.col(f"`{source}`") if source in df.columns else F.lit(fill)).alias(target)
            for target, source in mapping.items()
        ]
    )


def keep_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[f"`{c}`" for c in wanted if c in df.columns])


def conform(df: DataFrame, schema: T.StructType, fill: object = None) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones filled, types cast with
    bad values as NULL."""
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            column = F.lit(fill).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            column = F.col(f"`{field.name}`")
        else:
            column = F.col(f"`{field.name}`").try_cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def clean_names(names: Sequence[str], max_len: int = 64) -> list[str | None]:
    """Storable names, in place: trimmed, blanks, dots and dashes as ``_``,
    brackets removed, cut to ``max_len``, duplicates numbered ``_1``, ``_2``.
    ``None`` marks columns whose name is a null token."""
    table = str.maketrans({" ": "_", ".": "_", "-": "_", **dict.fromkeys("()[]")})
    repeats: dict[str, int] = {}
    out: list[str | None] = []
    for name in names:
        if name in NULL_NAMES:
            out.append(None)
            continue
        short = name.strip().translate(table)[:max_len]
        repeats[short] = repeats.get(short, -1) + 1
        suffix = f"_{repeats[short]}" if repeats[short] else ""
        out.append(short[: max_len - len(suffix)] + suffix)
    return out


def clean_columns(df: DataFrame, max_len: int = 64) -> DataFrame:
    """Rename all columns by clean_names, dropping the null-named ones.
    Positions are used, so the input may hold repeated names."""
    names = clean_names(df.columns, max_len)
    positional = df.toDF(*[f"_{i}" for i in range(len(names))])
    return positional.select(
        *[F.col(f"_{i}").alias(name) for i, name in enumerate(names) if name is not None]
    )


def drop_clashing(right: DataFrame, left: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``right`` without the columns ``left`` already has, ignoring case."""
    taken = {c.lower() for c in left.columns} - {c.lower() for c in keep}
    return right.select(*[f"`{c}`" for c in right.columns if c.lower() not in taken])


def suffixed(df: DataFrame, suffix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in columns})


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)
