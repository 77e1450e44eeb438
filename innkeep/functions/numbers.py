"""Numeric expressions and bands."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from innkeep.functions import as_col

MONEY = "decimal(18,2)"

# What a numeric column may hold as text.  Checked before the cast because the
# cast also takes Java suffixes such as "1.0d".
_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Labels and limits of the lead-time and stay-length bands.
LEAD_LIMITS = (30, 60, 90, 120, 180)
LEAD_LABELS = ("<= 30 days", "<= 60 days", "<= 90 days", "<= 120 days", "<= 180 days")
LEAD_OVER = "Acima de 180 days"
STAY_LIMITS = (3, 5, 7, 10, 15)
STAY_LABELS = ("<= 3 nigths", "<= 5 nigths", "<= 7 nigths", "<= 10 nigths", "<= 15 nigths")
STAY_OVER = "Acima de 15 nigths"
NO_BAND = "-"


def to_number(c: Column | str, kind: str = "double") -> Column:
    """Text to a number, NULL when it is not one.  Whole types accept ``12.0``."""
    text = as_col(c).cast("string")
    if kind in ("int", "bigint", "tinyint", "smallint"):
        value = text.try_cast("decimal(38,6)").try_cast(kind)
    else:
        value = text.try_cast(kind)
    return F.when(text.rlike(_NUMERIC), value)


def flag_int(c: Column | str) -> Column:
    """Boolean to 0/1/NULL."""
    return as_col(c).cast("int")


def nightly_rate(total: Column | str, nights: Column | str) -> Column:
    """``total / nights`` to the cent, half away from zero; NULL without nights."""
    total, nights = as_col(total).try_cast(MONEY), as_col(nights).cast("int")
    return F.when(nights > 0, F.round(total / nights, 2).cast("decimal(12,2)"))


def occupancy_rate(days: Column | str, length: Column | str) -> Column:
    """Share of a month's days, four digits, never above 1."""
    days, length = as_col(days), as_col(length)
    return F.round(F.least(days, length) / length, 4)


def drift(new: Column | str, base: Column | str) -> Column:
    """Relative change against ``base``; NULL on a zero base."""
    new, base = as_col(new), as_col(base)
    return F.try_divide(new - base, F.nullif(base, F.lit(0)))


def grew_within(new: Column, base: Column, limit: float) -> Column:
    """``base <= new <= base * (1 + limit)``; an empty base only accepts empty."""
    share = F.lit(Decimal(str(limit)))
    return F.when(base == 0, new == 0).otherwise((new >= base) & (new - base <= base * share))


def drifts_within(new: Column, base: Column, limit: float) -> Column:
    """``|new - base| <= limit * |base|``; a zero base only accepts zero."""
    share = F.lit(Decimal(str(limit)))
    return F.when(base == 0, new == 0).otherwise(F.abs(new - base) <= F.abs(base) * share)


def has_code(code: Column | str) -> Column:
    """True where a code is a positive number."""
    value = to_number(code)
    return F.coalesce(value > 0, F.lit(False))


def code_or(code: Column | str, fallback: Column | str) -> Column:
    """``code#`` for a positive numeric code, else the fallback as text."""
    code = as_col(code)
    return F.when(has_code(code), F.concat(code.cast("string"), F.lit("#"))).otherwise(
        F.coalesce(as_col(fallback).cast("string"), F.lit(""))
    )


def band(
    c: Column | str,
    limits: Sequence[int],
    labels: Sequence[str],
    over: str,
    null_label: str = NO_BAND,
) -> Column:
    """Label of the first limit that is not exceeded."""
    c = as_col(c)
    out = F.when(c.isNull(), null_label)
    for limit, label in zip(limits, labels, strict=True):
        out = out.when(c <= limit, label)
    return out.otherwise(over)


def band_order(c: Column | str, limits: Sequence[int], null_label: str = NO_BAND) -> Column:
    """Ordinal of the band as text, so that it can carry the null label."""
    order = [str(n) for n in range(1, len(limits) + 1)]
    return band(c, limits, order, str(len(limits) + 1), null_label)


def lead_band(days: Column | str) -> Column:
    return band(days, LEAD_LIMITS, LEAD_LABELS, LEAD_OVER)


def lead_order(days: Column | str) -> Column:
    return band_order(days, LEAD_LIMITS)


def stay_band(nights: Column | str) -> Column:
    return band(nights, STAY_LIMITS, STAY_LABELS, STAY_OVER)
