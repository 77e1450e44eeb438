"""Value cleaning over whole frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from innkeep.functions.dates import parse_date_flex

# Texts that mean "no value".
NULL_TOKENS = ("nan", "NaN", "None", "")


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null tokens to NULL in every text column, NaN to NULL in floats."""
    changed = {}
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = F.when(~c.isin(*tokens), c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.when(~F.isnan(c), c)
    return df.withColumns(changed) if changed else df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    changed = {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floats}
    return df.withColumns(changed) if changed else df


def remap(
    df: DataFrame, column: str, lookup: DataFrame, source: str = "from_id", target: str = "to_id"
) -> DataFrame:
    """Replace values found in ``lookup`` (one row per source); keep the others.
    Whether the lookup is broadcast is left to its size."""
    pairs = lookup.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    return (
        df.join(pairs, df[column] == F.col("_from"), "left")
        .withColumn(column, F.coalesce("_to", column))
        .drop("_from", "_to")
    )


def patch(df: DataFrame, key: str, column: str, patches: DataFrame) -> DataFrame:
    """Overwrite ``column`` where ``patches`` (key, column) has the row's key."""
    pairs = patches.select(F.col(key).alias("_key"), F.col(column).alias("_new"))
    return (
        df.join(pairs, df[key] == F.col("_key"), "left")
        .withColumn(column, F.coalesce("_new", column))
        .drop("_key", "_new")
    )


def set_where_in(
    df: DataFrame, column: str, values: Sequence[object], target: str, value: object
) -> DataFrame:
    """Set ``target`` where ``column`` is one of a short list of values."""
    if not values:
        return df
    hit = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return df.withColumn(target, F.when(hit, F.lit(value)).otherwise(F.col(target)))


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    changed = {
        f.name: F.to_json(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, nested)
    }
    return df.withColumns(changed) if changed else df


def cast_if_all_parse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn text columns into dates, each only if every non-null value parses.
    One aggregate over the table decides for all columns."""
    if not columns:
        return df
    counts = df.agg(
        *[(F.count(f"`{c}`") == F.count(parse_date_flex(f"`{c}`"))).alias(c) for c in columns]
    ).first()
    passing = {c: parse_date_flex(f"`{c}`") for c in columns if counts[c]}
    return df.withColumns(passing) if passing else df


def unparsed(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows whose raw value is present but did not parse."""
    return df.where(F.col(raw).isNotNull() & F.col(parsed).isNull())


def unparsed_samples(df: DataFrame, raw: str, parsed: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct values that did not parse, in text order."""
    return unparsed(df, raw, parsed).select(raw).distinct().orderBy(raw).limit(n)


def unparsed_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per raw column: how many values failed, and the smallest and
    largest failing value as samples.  One pass, whatever the column count."""
    aggregates = []
    for raw, parsed in checks.items():
        bad = F.when(F.col(raw).isNotNull() & parsed.isNull(), F.col(raw))
        aggregates += [F.count(bad), F.min(bad), F.max(bad)]
    wide = df.agg(*[a.alias(f"_{i}") for i, a in enumerate(aggregates)])
    rows = [
        F.struct(
            F.lit(raw).alias("column_name"),
            F.col(f"_{3 * i}").alias("unparsed"),
            F.col(f"_{3 * i + 1}").alias("sample_low"),
            F.col(f"_{3 * i + 2}").alias("sample_high"),
        )
        for i, raw in enumerate(checks)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
