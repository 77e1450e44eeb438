"""Date and time expressions.

No function reads the wall clock: whatever depends on "today" takes an
``as_of`` date.  Parsing always goes through the ``try_`` functions, because
under ANSI mode one bad value would otherwise fail the whole job.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from innkeep.functions import as_col

# Zone abbreviations understood in source timestamps.
ZONE_OFFSETS = {
    "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00",
    "UTC": "+00:00", "GMT": "+00:00",
}

# Fixed value: the zone wall-clock columns are stored in.
BUSINESS_ZONE = "America/Sao_Paulo"

# Timestamp shapes accepted by parse_ts, most specific first.  Each pattern is
# read with a trailing numeric offset, which parse_ts adds where it is missing.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm[:ss][.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS]",
    "M/d/yyyy H:mm[:ss][.SSSSSS]",
    "M/d/yyyy h:mm[:ss] a",
    "M/d/yyyy",
    "yyyy-MM-dd",
    "yyyy/M/d[ H:mm][:ss][.SSSSSS]",
    "M-d-yyyy[ H:mm][:ss][.SSSSSS]",
    "MMM d, yyyy[ H:mm][:ss][.SSSSSS]",
)

# The calendar starts here and ends this many days after
# December 31 of the current year.
CALENDAR_START = dt.date(2018, 1, 1)
CALENDAR_DAYS_AHEAD = 365 * 3

# Days before / after today covered by the housekeeping report,
# and days ahead for which prices are requested.
REPORT_DAYS_BACK = 5
REPORT_DAYS_FORWARD = 85
PRICE_DAYS_FORWARD = 547


def _day_or_month_first(c: Column, sep: str) -> Column:
    day_first = F.substring_index(c, sep, 1).try_cast("int") > 12
    return F.when(day_first, F.try_to_date(c, f"dd{sep}MM{sep}yyyy")).otherwise(
        F.try_to_date(c, f"MM{sep}dd{sep}yyyy")
    )


def parse_date_flex(c: Column | str) -> Column:
    """Text to date: ``NN/NN/YYYY`` and ``NN-NN-YYYY`` are day-first only when the
    first part exceeds 12, ``YYYY-MM-DD`` is ISO, anything else is NULL."""
    c = as_col(c)
    return (
        F.when(c.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), _day_or_month_first(c, "/"))
        .when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(c, "yyyy-MM-dd"))
        .when(c.rlike("^[0-9]{2}-[0-9]{2}-[0-9]{4}$"), _day_or_month_first(c, "-"))
    )


def as_date(df: DataFrame, name: str) -> Column:
    """Date of a column whatever its type: typed values are cast, text is parsed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_date_flex(name)
    return F.col(name).cast("date")


def parse_date(c: Column | str, fmt: str = "M/d/yyyy") -> Column:
    """Fixed-format text to date, NULL when it does not parse."""
    return F.try_to_date(as_col(c), fmt)


def parse_date_day_first(c: Column | str) -> Column:
    """``d/M/yyyy`` text to date, falling back to ISO."""
    c = as_col(c)
    return F.coalesce(F.try_to_date(c, "d/M/yyyy"), F.try_to_date(c, "yyyy-MM-dd"))


def zone_to_offset(c: Column | str) -> Column:
    """Squeeze blanks and replace a trailing zone abbreviation by its offset.
    Unknown abbreviations are left in place."""
    text = F.trim(F.regexp_replace(as_col(c), r"\s+", " "))
    abbr = F.regexp_extract(text, r"\b([A-Z]{2,4})$", 1)
    pairs = [F.lit(v) for kv in ZONE_OFFSETS.items() for v in kv]
    offset = F.try_element_at(F.create_map(*pairs), abbr)
    head = F.left(text, F.length(text) - F.length(abbr))
    return F.when(offset.isNotNull(), F.concat(head, offset)).otherwise(text)


def _read_if_shaped(text: Column, fmt: str) -> Column:
    """The text read by the format with an offset.  Where the format begins with a number
    and a slash or dash, texts that don't are NULL at once: a failed read costs more than
    any other step."""
    value = F.try_to_timestamp(text, F.lit(fmt + "XXX"))
    begin = re.match(r"(?:y{4}|M{1,2}|d{1,2})([/-])", fmt)
    return F.when(text.rlike(f"^[+-]?[0-9]+{begin[1]}"), value) if begin else value


def parse_ts(c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Mixed-format text to an instant (TIMESTAMP).  Text without an offset is
    UTC; offsets may lack their colon or minutes, fractions are cut at the
    microsecond; slashed and dashed dates are month-first unless they begin with the
    year; what no format reads becomes NULL."""
    text = F.regexp_replace(zone_to_offset(c), r"(\.\d{6})\d+", "$1")
    text = F.regexp_replace(text, r"(:\d{2}(?:\.\d+)?(?: [AaPp][Mm])?)\s*([+-]\d{2})$", "$1$2:00")
    text = F.regexp_replace(text, r"(:\d{2}(?:\.\d+)?(?: [AaPp][Mm])?)\s*([+-]\d{2})(\d{2})$", "$1$2:$3")
    text = F.regexp_replace(text, r"\s*([+-]\d{2}:\d{2})$", "$1")
    text = F.when(text.rlike(r"[+-]\d{2}:\d{2}$"), text).otherwise(
        F.concat(F.regexp_replace(text, "Z$", ""), F.lit("+00:00"))
    )
    return F.coalesce(*[_read_if_shaped(text, f) for f in formats])


def to_business_time(c: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """Instant to wall clock in ``zone``: floored to the second, zone dropped.
    Goes through the epoch, so the session time zone does not matter."""
    utc = F.timestamp_add(
        "SECOND",
        F.unix_seconds(as_col(c)),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def strip_zone(c: Column | str, literal: bool = False) -> Column:
    """Drop trailing zone letters.  AM and PM are not a zone, except with ``literal``,
    which drops any two to four capitals at the end."""
    letters = r"[A-Z]{2,4}$" if literal else r"(?<![A-Z])(?!(?:AM|PM)$)[A-Z]{2,4}$"
    return F.regexp_replace(as_col(c), r"\s?" + letters, "")


def parse_local_ts(
    c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS, literal: bool = False
) -> Column:
    """Text with or without zone letters to a wall-clock TIMESTAMP_NTZ."""
    return to_business_time(parse_ts(strip_zone(c, literal), formats), "UTC")


# -- months -----------------------------------------------------------------


_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "MM").cast("date")


def days_in_month(c: Column | str) -> Column:
    return F.day(F.last_day(as_col(c)))


def year_month(c: Column | str) -> Column:
    """``year * 100 + month``."""
    c = as_col(c)
    return F.year(c) * 100 + F.month(c)


def month_label(c: Column | str) -> Column:
    """``MM. MMM``, e.g. ``06. Jun``: one of twelve texts, which need not be formatted row by row."""
    return F.get(F.array(*[F.lit(f"{n:02}. {name}") for n, name in enumerate(_MONTHS, 1)]), F.month(as_col(c)) - 1)


def month_state(first: Column | str, as_of: dt.date) -> dict[str, Column]:
    """Length, elapsed days and complete/future flags of the month that starts
    on ``first``, as seen on ``as_of``."""
    first = as_col(first)
    today = F.lit(as_of)
    length = days_in_month(first)
    complete = F.last_day(first) < today
    future = first > today
    return {
        "days_in_month": length.cast("int"),
        "days_elapsed": F.when(future, 0)
        .when(complete, length)
        .otherwise(F.datediff(today, first) + 1)
        .cast("int"),
        "is_complete_month": complete.cast("int"),
        "is_future_month": future.cast("int"),
    }


# -- calendar ---------------------------------------------------------------


def calendar_end(as_of: dt.date) -> dt.date:
    return dt.date(as_of.year, 12, 31) + dt.timedelta(days=CALENDAR_DAYS_AHEAD)


def report_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    return (
        as_of - dt.timedelta(days=REPORT_DAYS_BACK),
        as_of + dt.timedelta(days=REPORT_DAYS_FORWARD),
    )


def arrival_days(as_of: dt.date) -> list[dt.date]:
    """Days whose arrivals are reported: on Fridays the weekend too."""
    ahead = 2 if as_of.weekday() == 4 else 0
    return [as_of + dt.timedelta(days=n) for n in range(ahead + 1)]


def relative_flags(adjusted: Column | str, as_of: dt.date) -> dict[str, Column]:
    """Year/month/week flags of an adjusted day against ``as_of``.  A missing day
    gives the "to go" labels.  The month flag compares the month number only."""
    day = as_col(adjusted)
    today = F.lit(as_of)
    ago = F.datediff(today, day)
    past = F.coalesce(day < today, F.lit(False))
    same_month = F.coalesce(F.month(day) == as_of.month, F.lit(False))
    return {
        "ytd": F.when(past, "YTD").otherwise("YTG"),
        "mtd": F.when(past & same_month, "MTD").otherwise("MTG"),
        "l7d": F.when(ago.between(1, 7), "L7D").otherwise("-"),
        "week": F.when(ago.between(1, 7), "S").when(ago.between(8, 14), "S-1").otherwise("-"),
    }


def year_label(c: Column | str, as_of: dt.date) -> Column:
    """``Y-n``, n years before ``as_of``'s year (``Y--1`` is next year)."""
    return F.concat(F.lit("Y-"), (F.lit(as_of.year) - F.year(as_col(c))).cast("string"))
