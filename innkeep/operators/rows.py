"""Row selection by key: filters, first/latest row, semi and anti joins, sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from innkeep.functions.text import collated


def not_in(c: Column | str, values: Sequence[object]) -> Column:
    """SQL NOT IN: NULL values do not pass."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.isin(*values) if values else F.lit(True)


def overlaps(start: Column | str, end: Column | str, a: dt.date, b: dt.date) -> Column:
    """Closed interval ``[start, end]`` meets ``[a, b]``."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return (end >= F.lit(a)) & (start <= F.lit(b))


def first_by(df: DataFrame, keys: Sequence[str], ordinal: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``ordinal`` order, which must leave no ties.

    Spark keeps at most one row per key on the map side (window group limit),
    so a hot key does not reach one task with all its rows."""
    w = W.partitionBy(*keys).orderBy(*ordinal)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_row(
    df: DataFrame, keys: Sequence[str], load_time: str, tiebreak: Sequence[str]
) -> DataFrame:
    """One row per key: the most recently loaded, ties by largest ``tiebreak``."""
    return first_by(df, keys, [F.desc(load_time), *[F.desc(c) for c in tiebreak]])


def latest_snapshot(df: DataFrame, keys: Sequence[str], load_time: str) -> DataFrame:
    """All rows of each key's most recent load."""
    newest = df.groupBy(*keys).agg(F.max(load_time).alias("_newest"))
    same = [F.col(f"d.{k}") == F.col(f"n.{k}") for k in keys]
    same.append(F.col(f"d.{load_time}") == F.col("n._newest"))
    return df.alias("d").join(newest.alias("n"), reduce(Column.__and__, same), "left_semi")


def pending(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not yet in ``done``."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def next_pending(
    df: DataFrame, done: DataFrame, keys: Sequence[str], n: int, order_by: Sequence[str]
) -> DataFrame:
    """The first ``n`` pending rows."""
    return pending(df, done, keys).orderBy(*order_by).limit(n)


def only_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_df``."""
    return df.join(keys_df.select(*on).distinct(), list(on), "left_semi")


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def distinct_collated(df: DataFrame, names: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """One row per spelling-independent name (and ``others``), shown in its smallest
    spelling by code points, with the number of spellings and of rows.  Spellings are
    counted first, so a name that most rows carry is a few rows when names meet."""
    shown = [*names, *others]
    spelled = df.groupBy(*shown).agg(F.count(F.lit(1)).alias("_n"))
    keyed = spelled.withColumns({f"_c{i}": collated(n) for i, n in enumerate(names)})
    first = F.min(F.struct(*names)).alias("_first")
    folded = keyed.groupBy(*[f"_c{i}" for i in range(len(names))], *others).agg(
        first, F.count(F.lit(1)).alias("spellings"), F.sum("_n").alias("n_rows")
    )
    return folded.select("_first.*", *others, "spellings", "n_rows")


def union_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both.  Copies are dropped before the rows meet."""
    return a.distinct().intersect(b.distinct())


def not_in_other(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks."""
    return pending(a, b, keys)


def first_sale(sold: DataFrame, keys: Sequence[str], booked: str, day: str) -> DataFrame:
    """First booking date, first and last sold day per key."""
    return (
        sold.where(F.col(booked).isNotNull() & F.col(day).isNotNull())
        .groupBy(*keys)
        .agg(
            F.min(booked).alias("first_booking"),
            F.max(day).alias("last_sold_day"),
            F.min(day).alias("first_sold_day"),
        )
    )


def join_ordered(
    df: DataFrame, keys: Sequence[str], text: str, pos: Sequence[str], alias: str, sep: str = ", "
) -> DataFrame:
    """Texts of each key joined in ``pos`` order, NULL texts left out.

    With several ordering columns, rows that share the first one are joined
    first: they are neighbours in the result, and a key with very many rows is
    worked on in parts before its one text is put together."""

    def listed(column: str, order: Sequence[str], name: str) -> Column:
        by = ", ".join(order)
        return F.expr(f"listagg({column}, '{sep}') within group (order by {by})").alias(name)

    if len(pos) == 1:
        return df.groupBy(*keys).agg(listed(text, pos, alias))
    parts = df.groupBy(*keys, pos[0]).agg(listed(text, pos[1:], "_part"))
    return parts.groupBy(*keys).agg(listed("_part", pos[:1], alias))
