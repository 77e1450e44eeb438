"""Calendar, unit list and house dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from innkeep import schemas
from innkeep.functions import dates as D
from innkeep.functions.numbers import to_number
from innkeep.operators.joins import lookup
from innkeep.functions.text import id_text, norm_key
from innkeep.operators.rows import latest_row, pending, union_ragged
from innkeep.operators.stays import unit_date_spine as spine

# Fixed value: what a unit without a renting type counts as.
NO_RENTING_TYPE = "NON-RENTING"
RENTING = "RENTING"

_HOUSE = (
    "id", "name", "location_name", "bedrooms_number", "bathrooms_number",
    "condo_type_name", "condo_type_group_name", "manager",
)


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day.  Spark knows the row count, hence the size."""
    n = (end - start).days + 1
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def calendar(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    adjusted: DataFrame | None,
    as_of: dt.date,
) -> DataFrame:
    """Calendar with year/month keys and relative flags of the adjusted day.

    ``adjusted`` has ``day_text`` (``dd-MM-yyyy``) and ``adjusted_day`` (a date or
    date text); days it does not list have no adjusted day.  Without the table, today is used."""
    base = days(spark, start, end)
    if adjusted is None:
        joined = base.withColumn("adjusted_day", F.lit(as_of))
    else:
        keyed = adjusted.withColumns(
            {
                "_day": D.parse_date("day_text", "dd-MM-yyyy"),
                "adjusted_day": D.as_date(adjusted, "adjusted_day"),
            }
        )
        joined = lookup(base, keyed, {"day": "_day"}, {"adjusted_day": "adjusted_day"})
    return joined.select(
        "day",
        F.date_format("day", "dd-MM-yyyy").alias("day_text"),
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        D.year_month("day").alias("year_month"),
        D.year_label("day", as_of).alias("year_label"),
        F.lit(as_of).alias("today"),
        "adjusted_day",
        *[c.alias(n) for n, c in D.relative_flags("adjusted_day", as_of).items()],
    )


def property_list(docs: DataFrame, load_time: Column, body: str = "body") -> DataFrame:
    """Properties of each manager's response (manager, body), typed, with their
    load time; appended loads make up the history of the house dimension."""
    rows = docs.select(
        "manager",
        F.inline(F.from_json(body, schemas.PROPERTIES_DOC).getField("data").getField("property")),
    )
    whole = ("id", "bedrooms_number", "bathrooms_number", "max_adults")
    return rows.withColumns(
        {**{c: to_number(c, "bigint") for c in whole}, "load_time": load_time}
    )


def _one_spelling(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys`` and manager, however the manager is spelled: as listed
    (``_listed``) where it is, else the first spelling in order."""
    folded = rows.groupBy(*keys, norm_key("manager").alias("_folded")).agg(
        F.min(F.when(F.col("_listed"), F.col("manager"))).alias("_shown"),
        F.min("manager").alias("_any"),
    )
    return folded.select(*keys, F.coalesce("_shown", "_any").alias("manager"))


def spine_units(properties: DataFrame, reservations: DataFrame) -> DataFrame:
    """One (id, manager) per unit of rented-out properties and of reservations;
    managers that differ in case, accents or trailing blanks only are the same."""
    listed = properties.where(F.col("renting_type") == RENTING).select("id", "manager", F.lit(True).alias("_listed"))
    booked = reservations.select(F.col("unit_id").alias("id"), "manager", F.lit(False).alias("_listed"))
    units = listed.unionByName(booked)
    if isinstance(units.schema["id"].dataType, T.StringType):
        units = units.withColumn("id", id_text("id"))
    return _one_spelling(units, ["id"])


def unit_date_spine(
    properties: DataFrame, reservations: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Every unit on every day; ids as text and days as ``MM/dd/yyyy`` text are
    available through ``spine_text``."""
    return spine(spine_units(properties, reservations), start, end)


def _day_texts(start: dt.date, end: dt.date) -> Column:
    """``MM/dd/yyyy`` texts of all days from ``start`` to ``end``, one constant list."""
    every = (start + dt.timedelta(n) for n in range((end - start).days + 1))
    return F.split(F.lit(",".join(f"{d.month:02}/{d.day:02}/{d.year:04}" for d in every)), ",")


def spine_text(df: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The spine as it is stored for text consumers.  Days from ``start`` to ``end`` take
    their text from a list; only others are formatted row by row."""
    text = F.date_format("date", "MM/dd/yyyy")
    if start is not None and end is not None:
        text = F.coalesce(F.get(_day_texts(start, end), F.date_diff("date", F.lit(start))), text)
    return df.select(F.col("id").cast("string").alias("id"), "manager", text.alias("date"))


def house_dimension(
    properties: DataFrame,
    history: DataFrame,
    reservations: DataFrame,
    load_time: str = "load_time",
    match_manager: bool = True,
) -> DataFrame:
    """All units ever known: listed ones, the latest history row of each id, and
    booked units that are not listed (with empty attributes).  Rows that differ
    in the spelling of the manager only are one.

    The renting type comes from the current list, matched on id and manager
    (``match_manager=False``: on id alone, which repeats rows when several
    managers list an id)."""
    current = properties.select(*_HOUSE)
    past = latest_row(history, ["id"], load_time, list(_HOUSE[1:])).select(*_HOUSE)
    booked = reservations.select(F.col("unit_id").alias("id"), "manager").distinct()
    unlisted = pending(booked, properties, ["id"]).select(
        *[
            F.col(c) if c in ("id", "manager") else F.lit(None).cast(properties.schema[c].dataType).alias(c)
            for c in _HOUSE
        ]
    )
    listed = F.lit(True).alias("_listed")
    known = union_ragged([current.select("*", listed), past, unlisted])
    houses = _one_spelling(known, [c for c in _HOUSE if c != "manager"]).select(*_HOUSE)
    on = {"id": "id", "manager": "manager"} if match_manager else {"id": "id"}
    text_keys = ("manager",) if match_manager else ()
    typed = lookup(houses, properties, on, {"renting_type": "renting_type"}, text_keys)
    return typed.withColumn("renting_type", renting_or_default("renting_type"))


def renting_or_default(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(NO_RENTING_TYPE))
