"""Queries of stored marts: bucketed inputs, and upkeep by change."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, functions as F

from innkeep.domain import queries_marts as M, views as V
from innkeep.domain.registry import query
from innkeep.plans import stored_by_date, stored_days, unit_days
from innkeep.plans.stored_by_date import ByDateSource
from innkeep.plans.stored_days import PARTITION, DaySource
from innkeep.session import scratch_path, stored

BUCKETS = 8


def _refreshed(done: int) -> None:
    """The states differ, so something must have been computed.  In large tables the
    change may reach every partition."""
    if done == 0:
        raise ValueError("no partition was computed")


def _base_source(data: unit_days.Inputs) -> DaySource:
    units, sales = unit_days.base_parts(data)
    return DaySource(stored(units, "units"), sales, data.target_rates, data.prices, {"seasons": (data.seasons, "date")}, {})


@query(M._BASE_VIEWS, M._BASE_SQL + M._digest_sql("unit_days", M.BASE_COLUMNS))
def unit_days_stored(spark, sf):
    """The base unit-day mart from bucketed sales, rates and prices, stored by month and
    group of units: rows, sold rows and a hash of all values per unit and month."""
    path = scratch_path(spark, "unit-days")
    data = M._inputs(spark, sf, V.listed_units(spark, sf))
    finish = partial(unit_days.finish_base, seasons=data.seasons)
    stored_days.build_unit_days(_base_source(data), finish, path, *V.HORIZON, BUCKETS)
    return M._by_unit_and_month(spark.read.parquet(path).drop(*PARTITION), M.BASE_COLUMNS)


def _sales_source(spark, sf, data: unit_days.Inputs, calendar: DataFrame) -> DaySource:
    units, sales, _ = unit_days.sales_parts(
        data,
        calendar,
        stored(V.sale_status(spark, sf), "sale_status"),
        stored(V.channels(spark, sf), "channels"),
        V.target_units(spark, sf),
        V.mirror_units(spark, sf).select(F.col("from_id").alias("unit_id")),
    )
    return DaySource(
        stored(units, "units"),
        stored(sales, "day-sales"),
        data.target_rates,
        data.prices,
        {"seasons": (data.seasons, "date")},
        {"calendar": (calendar, "day")},
    )


@query(M._SALES_VIEWS, M._SALES_SQL + M._digest_sql("finished", M.SALES_COLUMNS))
def unit_days_upkept(spark, sf):
    """The sales mart brought from one load to the next: nights sold since, changed rates,
    prices and seasons.  Only touched months of touched units are computed; the result is that of a
    full build on the new load."""
    path = scratch_path(spark, "unit-days")
    new = M._inputs(spark, sf, M._houses_of(spark, sf))
    calendar = stored(M.calendar_of(spark, sf), "calendar")
    spring = F.col("date").between(F.lit("1996-03-01").cast("date"), F.lit("1996-04-15").cast("date"))
    night = F.col("date").isNull() | ~spring | (F.col("unit_id") % 100 != 1)
    old = replace(
        new,
        sales=new.sales.where(night),
        target_rates=new.target_rates.withColumn("rate", F.col("rate") + F.when(spring & (F.col("id_unit") % 50 == 1), 1.0).otherwise(0.0)),
        prices=new.prices.where(~spring | (F.col("id_unit") % 50 != 1)),
        seasons=new.seasons.withColumn("season", F.when(spring & (F.col("manager") == "BUILDING"), "OLD").otherwise(F.col("season"))),
    )
    first, second = (_sales_source(spark, sf, x, calendar) for x in (old, new))
    build = partial(unit_days.finish_sales, calendar=calendar, as_of=V.AS_OF)
    stored_days.build_unit_days(first, partial(build, seasons=old.seasons), path, *V.HORIZON, BUCKETS)
    finish = partial(build, seasons=new.seasons)
    _refreshed(stored_days.refresh_unit_days(first, second, finish, path, *V.HORIZON, BUCKETS))
    return M._by_unit_and_month(spark.read.parquet(path).drop(*PARTITION), M.SALES_COLUMNS)


@query("sales", "SELECT * FROM sales")
def by_date_upkept(spark, sf):
    """By-date reservations brought from one load to the next: new and moved bookings,
    dropped ones, new prices."""
    path = scratch_path(spark, "by-date")
    rows, prices = V.reservations(spark, sf), V.price_days(spark, sf)
    new = ByDateSource(rows, prices, V.mirror_units(spark, sf), V.booking_patches(spark, sf))
    recent = F.col("startdate") >= F.lit("1998-05-01").cast("date")
    moved = rows.where(~recent | (F.col("id") % 5 > 0)).withColumn(
        "startdate", F.when(recent & (F.col("id") % 7 == 0), F.date_add("startdate", 40)).otherwise(F.col("startdate"))
    )
    gone = rows.where(F.col("startdate") < F.lit("1992-03-01").cast("date")).withColumns(
        {"id": -F.col("id"), "startdate": F.lit("1991-01-31").cast("date")}
    )
    old = replace(
        new,
        reservations=moved.unionByName(gone),
        price_days=prices.where("reservation_id % 5003 > 0 or season = 'A'"),
    )
    stored_by_date.build_by_date(old, path)
    _refreshed(stored_by_date.refresh_by_date(old, new, path))
    return spark.read.parquet(path).drop(stored_by_date.MONTH)
