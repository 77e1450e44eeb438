"""Left joins.

No hint forces a broadcast here.  Spark broadcasts a side whose size it knows
to be below ``spark.sql.autoBroadcastJoinThreshold`` (AQE measures it after the
shuffle) and otherwise sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from innkeep.functions.text import collated, norm_key


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    text_keys: Sequence[str] = (),
) -> DataFrame:
    """Left join ``dim`` and take ``target: dim column`` pairs.

    ``on`` maps df keys to dim keys.  Keys listed in ``text_keys`` are compared
    without regard to case and trailing blanks.  NULL keys match nothing."""
    side = dim.select(
        *[
            (norm_key(F.col(f"`{d}`")) if k in text_keys else F.col(f"`{d}`")).alias(f"_k{i}")
            for i, (k, d) in enumerate(on.items())
        ],
        *[F.col(f"`{d}`").alias(f"_v{i}") for i, d in enumerate(columns.values())],
    )
    same = [
        (norm_key(F.col(f"`{k}`")) if k in text_keys else F.col(f"`{k}`")) == F.col(f"_k{i}")
        for i, k in enumerate(on)
    ]
    kept = [F.col(f"`{c}`") for c in df.columns]
    added = [F.col(f"_v{i}").alias(target) for i, target in enumerate(columns)]
    return df.join(side, reduce(Column.__and__, same), "left").select(*kept, *added)


def lookup_collated(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]
) -> DataFrame:
    """``lookup`` with text keys compared under the Unicode collation.  ``on`` holds text
    columns only; NULL keys match nothing."""
    side = dim.select(
        *[collated(f"`{d}`").alias(f"_k{i}") for i, d in enumerate(on.values())],
        *[F.col(f"`{d}`").alias(f"_v{i}") for i, d in enumerate(columns.values())],
    )
    same = [collated(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(on)]
    kept = [F.col(f"`{c}`") for c in df.columns]
    added = [F.col(f"_v{i}").alias(target) for i, target in enumerate(columns)]
    return df.join(side, reduce(Column.__and__, same), "left").select(*kept, *added)


def left_details(
    head: DataFrame,
    detail: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    latest: str | None = None,
) -> DataFrame:
    """Left join of a one-to-many detail.  With ``latest`` only the detail rows
    of each key's largest ``latest`` value are joined.

    Written as inner join plus the heads without detail: an inner join lets AQE
    split a hot key on the detail side, which a left outer join does not.  The
    latest load is found by aggregation and carried by the heads, so the detail
    itself moves once."""
    keys = [f"_k{i}" for i in range(len(on))]
    side = detail.select(
        *[F.col(f"`{d}`").alias(k) for k, d in zip(keys, on.values())],
        *([F.col(latest).alias("_load")] if latest else []),
        *[F.col(f"`{d}`").alias(target) for target, d in columns.items()],
    )
    same = [F.col(f"`{h}`") == F.col(k) for h, k in zip(on, keys)]
    known = side.groupBy(*keys).agg(F.max("_load" if latest else F.lit(1)).alias("_newest"))
    marked = head.join(known, reduce(Column.__and__, same), "left").drop(*keys)
    lone = marked.where("_newest is null").drop("_newest")
    if latest:
        same.append(F.col("_newest") == F.col("_load"))
    matched = marked.where("_newest is not null").join(side, reduce(Column.__and__, same), "inner")
    return matched.drop(*keys, "_newest", "_load").unionByName(lone, allowMissingColumns=True)
