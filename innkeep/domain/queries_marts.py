"""Queries of the marts over reservations, units and days."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, functions as F, types as T

from innkeep.domain import views as V
from innkeep.domain.registry import query
from innkeep.domain.views_sql import folded
from innkeep.functions.text import norm_key
from innkeep.operators.stays import day_bits
from innkeep.plans import dimensions, occupancy, unit_days
from innkeep.plans.reservations import reservations_by_date as by_date
from innkeep.session import stored


@query(
    "units reservations",
    """WITH grid AS (
        SELECT id AS unit_id, CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01',
                                                          INTERVAL 1 MONTH)) AS DATE) AS first_day
        FROM units WHERE renting_type = 'RENTING'),
    days AS (
        SELECT DISTINCT unit_id, CAST(unnest(generate_series(startdate, enddate, INTERVAL 1 DAY)) AS DATE) AS d
        FROM reservations),
    counts AS (
        SELECT unit_id, CAST(date_trunc('month', d) AS DATE) AS first_day, count(*) AS n,
               count(*) FILTER (d <= DATE '1998-06-15') AS past
        FROM days GROUP BY ALL)
    SELECT g.unit_id, year(g.first_day) AS year, month(g.first_day) AS month,
           strftime(g.first_day, '%Y-%m') AS month_str,
           round(coalesce(n, 0) / day(last_day(g.first_day)), 4) AS occupancy_rate,
           coalesce(n, 0) AS days_occupied, day(last_day(g.first_day)) AS days_in_month,
           CASE WHEN g.first_day > DATE '1998-06-15' THEN 0
                WHEN last_day(g.first_day) < DATE '1998-06-15' THEN day(last_day(g.first_day))
                ELSE date_diff('day', g.first_day, DATE '1998-06-15') + 1 END AS days_elapsed,
           coalesce(past, 0) AS days_occupied_past, coalesce(n - past, 0) AS days_occupied_future,
           CAST(last_day(g.first_day) < DATE '1998-06-15' AS BIGINT) AS is_complete_month,
           CAST(g.first_day > DATE '1998-06-15' AS BIGINT) AS is_future_month
    FROM grid g LEFT JOIN counts c ON g.unit_id = c.unit_id AND g.first_day = c.first_day""",
)
def monthly_occupancy(spark, sf):
    """Occupied days and rate of every unit and month."""
    units = V.units(spark, sf).select(F.col("id").alias("unit_id"), "renting_type")
    return occupancy.monthly_occupancy(V.bookings(spark, sf), units, V.YEARS, V.AS_OF)


_DAILY = """WITH stays AS (
        SELECT unit_id, CAST(confirmation_id AS VARCHAR) AS confirmation_id, startdate, enddate,
               (2 * CAST(round(price_nightly * 100) AS BIGINT) + days_number) // (2 * days_number) AS cents
        FROM reservations
        WHERE unit_id IN (SELECT id FROM units WHERE renting_type = 'RENTING') AND price_nightly > 0),
    days AS (
        SELECT *, CAST(unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS DATE) AS occupied_date
        FROM stays WHERE {where})
    SELECT unit_id, confirmation_id, occupied_date, CAST(1 AS BIGINT) AS days, year(occupied_date) AS year,
           month(occupied_date) AS month, day(occupied_date) AS day,
           strftime(occupied_date, '%Y-%m') AS month_str, startdate, enddate,
           CAST(cents AS DOUBLE) / 100 AS rate
    FROM days"""


def _houses(spark, sf):
    return V.units(spark, sf).select(F.col("id").alias("unit_id"), "renting_type")


@query("units reservations", _DAILY.format(lo="startdate", hi="enddate", where="true"))
def daily_occupancy(spark, sf):
    """One row per unit, confirmation and occupied day, over all years."""
    return occupancy.daily_occupancy(V.bookings(spark, sf), _houses(spark, sf), V.YEARS)


@query(
    "units reservations",
    _DAILY.format(
        lo="greatest(startdate, DATE '1998-01-01')",
        hi="least(enddate, DATE '1998-12-31')",
        where="enddate >= DATE '1998-01-01' AND startdate <= DATE '1998-12-31'",
    ),
)
def daily_occupancy_clipped(spark, sf):
    """Occupied days of one target year, cut at its ends."""
    import datetime as dt

    year = (dt.date(1998, 1, 1), dt.date(1998, 12, 31))
    return occupancy.daily_occupancy(V.bookings(spark, sf), _houses(spark, sf), 1998, clip=year)


def calendar_of(spark, sf):
    return dimensions.calendar(spark, *V.HORIZON, V.adjusted_days(spark, sf), V.AS_OF)


@query("calendar", "SELECT * FROM calendar")
def calendar_flags(spark, sf):
    """Calendar with year/month keys and relative flags."""
    return calendar_of(spark, sf)


@query(
    "spine_units",
    """SELECT CAST(id AS VARCHAR) AS id, manager,
           strftime(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-30', INTERVAL 1 DAY)),
                    '%m/%d/%Y') AS date
    FROM spine_units""",
)
def unit_date_spine(spark, sf):
    """Every unit on every day of the horizon."""
    spine = dimensions.unit_date_spine(V.listed_units(spark, sf), V.reservations(spark, sf), *V.HORIZON)
    return dimensions.spine_text(spine, *V.HORIZON)


def _houses_of(spark, sf):
    return dimensions.house_dimension(
        V.listed_units(spark, sf), V.unit_history(spark, sf), V.reservations(spark, sf)
    )


@query("houses", "SELECT * FROM houses")
def house_dimension(spark, sf):
    """All units ever known, with attributes where there are any."""
    return _houses_of(spark, sf)


def _sales_of(spark, sf):
    return by_date(
        V.reservations(spark, sf),
        V.price_days(spark, sf),
        V.mirror_units(spark, sf),
        V.booking_patches(spark, sf),
    )


@query("sales", "SELECT * FROM sales")
def reservations_by_date(spark, sf):
    """Reservations with their latest nightly prices."""
    return _sales_of(spark, sf)


@query(
    "reservations price_days mirror_units",
    """SELECT r.id, coalesce(m.to_id, r.unit_id) AS unit_id, p.date, p.price, p.data_price
    FROM reservations r LEFT JOIN price_days p ON r.id = p.reservation_id
    LEFT JOIN mirror_units m ON r.unit_id = m.from_id WHERE r.status_id IN (4, 5, 6, 7)""",
)
def reservations_by_date_all_loads(spark, sf):
    """Reservations with the prices of every load."""
    rows = by_date(
        V.reservations(spark, sf),
        V.price_days(spark, sf),
        V.mirror_units(spark, sf),
        latest_only=False,
    )
    return rows.select("id", "unit_id", "date", "price", "data_price")


def _inputs(spark, sf, houses) -> unit_days.Inputs:
    """Inputs of the unit-day marts.  By-date rows and seasons are tables of
    their own that the mart reads more than once, so they are stored first."""
    return unit_days.Inputs(
        properties=V.listed_units(spark, sf),
        reservations=V.reservations(spark, sf),
        sales=stored(_sales_of(spark, sf), "sales"),
        target_rates=V.target_rates(spark, sf),
        prices=V.current_prices(spark, sf),
        seasons=stored(V.seasons(spark, sf), "seasons"),
        houses=houses,
    )


# A row of a wide mart as text: amounts with two decimals, NULL as a tilde.  The rows of a
# unit and month are compared by the sum of their hashes, so that every value of every row
# over the whole horizon counts, while the result stays small enough to be collected.
_AMOUNTS = {
    "price_nightly", "price_total", "price", "extra", "discount", "original_cost", "target_rate", "current_rate",
}
_DAY_COLUMNS = (
    "unit_id", "manager", "date", "reservation", "sale_location", "target_season", "target_rate",
    "target_min_stay", "current_min_stay", "current_rate", "target_occupancy", "season_name", "renting_type",
)
# What is the same on all days of a unit, and what else a day has that is neither sold nor has a rate.
_OF_UNIT = {
    *unit_days.HOUSE_COLUMNS, "unit_id", "manager", "max_adults", "renting_type", "in_target",
    "first_booking", "last_sold_day", "first_sold_day",
}
_OF_EVERY_DAY = {
    "date", "target_occupancy", "season_name", "sale_status", "stay_year_label", "stay_adjusted_day", "year", "month",
    "is_future", "stay_month", "lead_band", "lead_order", "stay_band", "holiday_of_year", "holiday_name", "holiday_days",
    "season_interval",
}
BASE_COLUMNS = sorted((*_DAY_COLUMNS, *unit_days.HOUSE_COLUMNS, *unit_days.SALE_COLUMNS, "max_adults"))
SALES_COLUMNS = sorted(
    (
        *_DAY_COLUMNS, *unit_days.HOUSE_COLUMNS, *unit_days.SALE_COLUMNS,
        "holiday_of_year", "holiday_name", "holiday_days", "season_interval", "sale_status", "in_target",
        "channel", "booking_year_month", "booking_adjusted_day", "ytd", "mtd", "l7d", "week",
        "booking_year_label", "stay_year_label", "stay_adjusted_day", "year", "month", "is_future",
        "lead_days", "booking_month", "stay_month", "lead_band", "lead_order", "stay_band",
        "first_booking", "last_sold_day", "first_sold_day",
    )
)


#: Days whose text is taken from a list; that of others is made row by row.
_LISTED = (dt.date(1990, 1, 1), dt.date(2004, 12, 31))


def _text(c: str, kind: T.DataType):
    """A value as the SQL side shows it."""
    if c in _AMOUNTS:
        return F.col(c).cast("decimal(18,2)").cast("string")
    if isinstance(kind, T.DateType):
        first, last = _LISTED
        every = ",".join((first + dt.timedelta(n)).isoformat() for n in range((last - first).days + 1))
        return F.coalesce(F.get(F.split(F.lit(every), ","), F.date_diff(c, F.lit(first))), F.col(c).cast("string"))
    return F.col(c).cast("string")


def _unit_texts(columns):
    """Texts of the runs of a row's columns that are the same on all days of a unit."""
    return {
        f"_text_of_{run[0]}": F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in run])
        for kind, run in _runs(columns)
        if kind == "unit"
    }


def _runs(columns):
    """Neighbouring columns of one kind: of the unit, of its day, of a sale or rate."""
    kind = lambda c: "unit" if c in _OF_UNIT else "day" if c in _OF_EVERY_DAY else "sale"
    return [(k, list(run)) for k, run in groupby(columns, kind)]


def _row_text(rows, columns):
    """All values of a row.  Attributes of sales and rates are missing from most rows:
    neighbours that are missing all together are one constant there.  Texts of the unit's
    attributes are taken from ``_unit_texts`` if the rows have them."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    pieces = []
    for kind, run in _runs(columns):
        texts = [F.coalesce(_text(c, kinds[c]), F.lit("~")) for c in run]
        if kind == "unit" and f"_text_of_{run[0]}" in kinds:
            texts = [F.col(f"_text_of_{run[0]}")]
        elif kind == "sale" and len(run) > 1:
            missing = reduce(Column.__and__, [F.col(c).isNull() for c in run])
            texts = [F.when(missing, "|".join("~" * len(run))).otherwise(F.concat_ws("|", *texts))]
        pieces += texts
    return F.concat_ws("|", *pieces)


def _by_unit_and_month(rows, columns):
    """Number of rows, sold ones and hashes of whole rows, per unit and month."""
    given = [c for c in rows.columns if not c.startswith("_text_of_")]
    if sorted(given) != columns:
        raise ValueError(f"other columns than expected: {set(given) ^ set(columns)}")
    digest = F.conv(F.substring(F.md5(_row_text(rows, columns)), 1, 12), 16, 10).cast("bigint")
    # chosen before they are summed, the values are made in each part of the mart and few go on
    chosen = rows.select("unit_id", "manager", F.trunc("date", "MM").alias("first_day"), "reservation", digest.alias("digest"))
    return chosen.groupBy("unit_id", "manager", "first_day").agg(
        F.count(F.lit(1)).alias("unit_days"), F.count("reservation").alias("sold"), F.sum("digest").alias("digest")
    )


def _digest_sql(source: str, columns) -> str:
    texts = ", ".join(
        f"coalesce(CAST({f'CAST({c} AS DECIMAL(18,2))' if c in _AMOUNTS else c} AS VARCHAR), '~')" for c in columns
    )
    return f"""
    SELECT unit_id, manager, CAST(date_trunc('month', date) AS DATE) AS first_day, count(*) AS unit_days,
           count(reservation) AS sold,
           CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 12) AS BIGINT)) AS BIGINT) AS digest
    FROM {source} GROUP BY ALL"""


_SALE = ", ".join(
    c if c not in ("hear_about_name", "travelagent_name") else f"CAST(NULL AS VARCHAR) AS {c}"
    for c in unit_days.SALE_COLUMNS
)
_HOUSE = ", ".join(unit_days.HOUSE_COLUMNS)

# What the marts hold, by definition: each sale of a known unit, and each day of the
# horizon on which a known unit has none.  The caller says what is known of units
# (``known_units``) and of bookings (``bookings``).
_UNIT_DAYS = """
    sold AS (
        SELECT * FROM known_units JOIN bookings USING (unit_id, manager)
        WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-12-30'),
    free AS (
        SELECT * FROM known_units,
             (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-30', INTERVAL 1 DAY)) AS DATE) AS date)
        WHERE (unit_id, manager, date) NOT IN (SELECT (unit_id, manager, date) FROM sold)),
    wanted AS (
        SELECT id_unit AS unit_id, manager, date, season AS target_season, rate AS target_rate,
               min_stay AS target_min_stay FROM target_rates),
    asked AS (
        SELECT id_unit AS unit_id, manager, date, rate AS current_rate, min_stay AS current_min_stay
        FROM current_prices),
    unit_days AS (
        SELECT *, CAST(NULL AS VARCHAR) AS sale_location
        FROM (SELECT * FROM sold UNION ALL BY NAME SELECT * FROM free)
        LEFT JOIN wanted USING (unit_id, manager, date) LEFT JOIN asked USING (unit_id, manager, date)
        LEFT JOIN (SELECT * RENAME (occupancy AS target_occupancy, season AS season_name) FROM seasons)
            USING (manager, date))
"""
_BASE_VIEWS = "spine_units sales target_rates current_prices listed_units seasons"
_BASE_SQL = f"""WITH known_units AS (
        SELECT s.id AS unit_id, s.manager, {_HOUSE}, max_adults, renting_type
        FROM spine_units s LEFT JOIN listed_units h ON h.id = s.id AND {folded("h.manager")} = {folded("s.manager")}),
    bookings AS (SELECT unit_id, manager, date, id AS reservation, {_SALE} FROM sales),
    {_UNIT_DAYS}"""


@query(_BASE_VIEWS, _BASE_SQL + _digest_sql("unit_days", BASE_COLUMNS))
def unit_day_base(spark, sf):
    """Every unit and day of the horizon with sales, rates and attributes: rows, sold
    rows and a hash of all values per unit and month."""
    data = _inputs(spark, sf, V.listed_units(spark, sf))
    rows = unit_days.unit_day_base(data, *V.HORIZON, per_unit=_unit_texts(BASE_COLUMNS))
    return _by_unit_and_month(rows, BASE_COLUMNS)


def _respelled(df):
    """The manager in another case, with accents or trailing blanks, by booking type."""
    kind = F.col("type_name")
    return df.withColumn(
        "manager",
        F.when(kind == "1-URGENT", F.lower("manager"))
        .when(kind == "2-HIGH", F.concat("manager", F.lit("  ")))
        .when(kind == "3-MEDIUM", F.translate("manager", "AEIOU", "ÁÊÍÕÜ"))
        .otherwise(F.col("manager")),
    )


@query(
    _BASE_VIEWS,
    _BASE_SQL
    + f"""
    SELECT unit_id, {folded("manager")} AS manager_key, count(*) AS unit_days, count(DISTINCT date) AS days,
           count(reservation) AS sold, count(name) AS named
    FROM unit_days GROUP BY ALL""",
)
def unit_days_respelled(spark, sf):
    """Units whose bookings spell the manager in several ways have each day once."""
    data = _inputs(spark, sf, V.listed_units(spark, sf))
    data = replace(data, reservations=_respelled(data.reservations), sales=_respelled(data.sales))
    rows = unit_days.unit_day_base(data, *V.HORIZON)
    return _days_per_unit(rows)


def _days_per_unit(rows):
    """Rows, different days, sold and named rows per unit, however its manager is spelled.
    Days are bits of their month, which merge before the shuffle."""
    day = F.day("date")
    months = rows.groupBy("unit_id", norm_key("manager").alias("manager_key"), F.trunc("date", "MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("unit_days"),
        F.bit_or(day_bits(day, day)).alias("_days"),
        F.count("reservation").alias("sold"),
        F.count("name").alias("named"),
    )
    return months.groupBy("unit_id", "manager_key").agg(
        F.sum("unit_days").alias("unit_days"),
        F.coalesce(F.sum(F.bit_count("_days")), F.lit(0)).cast("bigint").alias("days"),
        F.sum("sold").alias("sold"),
        F.sum("named").alias("named"),
    )


def _bands(column: str, limits, unit: str) -> str:
    """CASE over ascending limits; the labels are fixed."""
    cases = " ".join(f"WHEN {column} <= {n} THEN '<= {n} {unit}'" for n in limits)
    return f"CASE WHEN {column} IS NULL THEN '-' {cases} ELSE 'Acima de {limits[-1]} {unit}' END"


_LEAD = (30, 60, 90, 120, 180)
_LEAD_ORDER = " ".join(f"WHEN lead_days <= {n} THEN '{i}'" for i, n in enumerate(_LEAD, 1))
_SALES_SQL = f"""WITH known_units AS (
        SELECT s.id AS unit_id, s.manager, {_HOUSE}, coalesce(renting_type, 'NON-RENTING') AS renting_type,
               coalesce((SELECT max(value) FROM target_units t WHERE t.id_unit = s.id), 'NÃO') AS in_target,
               first_booking, last_sold_day, first_sold_day
        FROM spine_units s LEFT JOIN houses h ON h.id = s.id AND {folded("h.manager")} = {folded("s.manager")}
        LEFT JOIN (SELECT unit_id, manager, min(creation_date) AS first_booking, max(date) AS last_sold_day,
                          min(date) AS first_sold_day
                   FROM sales WHERE id > 0 AND creation_date IS NOT NULL AND date IS NOT NULL GROUP BY ALL) f
            ON f.unit_id = s.id AND f.manager = s.manager
        WHERE s.id NOT IN (SELECT from_id FROM mirror_units)),
    bookings AS (
        SELECT unit_id, manager, date, id AS reservation, {_SALE}, channel,
               year_month AS booking_year_month, adjusted_day AS booking_adjusted_day, ytd, mtd, l7d, week,
               year_label AS booking_year_label,
               (SELECT max(status) FROM sale_status o WHERE {folded("o.type_name")} = {folded("sales.type_name")}) AS sold_as
        FROM sales LEFT JOIN channels USING (type_name)
        LEFT JOIN (SELECT day, year_month, adjusted_day, ytd, mtd, l7d, week, year_label FROM calendar)
            ON creation_date = day),
    {_UNIT_DAYS},
    finished AS (
        SELECT *, {_bands("lead_days", _LEAD, "days")} AS lead_band,
               CASE WHEN lead_days IS NULL THEN '-' {_LEAD_ORDER} ELSE '{len(_LEAD) + 1}' END AS lead_order,
               {_bands("days_number", (3, 5, 7, 10, 15), "nigths")} AS stay_band
        FROM (SELECT u.*, coalesce(sold_as, 'Disponivel') AS sale_status, year(date) AS year, month(date) AS month,
                     CAST(date >= DATE '1998-06-15' AS BIGINT) AS is_future,
                     date_diff('day', creation_date, date) AS lead_days,
                     strftime(booking_adjusted_day, '%m. %b') AS booking_month, strftime(date, '%m. %b') AS stay_month,
                     stay.year_label AS stay_year_label, stay.adjusted_day AS stay_adjusted_day
              FROM unit_days u LEFT JOIN calendar stay ON stay.day = u.date))
"""
_SALES_VIEWS = (
    "spine_units sales target_rates current_prices houses seasons sale_status target_units "
    "channels calendar mirror_units"
)


def _unit_day_sales(spark, sf, per_unit=None):
    return unit_days.unit_day_sales(
        _inputs(spark, sf, _houses_of(spark, sf)),
        stored(calendar_of(spark, sf), "calendar"),
        stored(V.sale_status(spark, sf), "sale_status"),
        stored(V.channels(spark, sf), "channels"),
        V.target_units(spark, sf),
        V.mirror_units(spark, sf).select(F.col("from_id").alias("unit_id")),
        *V.HORIZON,
        V.AS_OF,
        per_unit,
    )


@query(_SALES_VIEWS, _SALES_SQL + _digest_sql("finished", SALES_COLUMNS))
def unit_day_sales(spark, sf):
    """Unit-day sales of the whole horizon with bands, flags and first-sale dates: rows,
    sold rows and a hash of all values per unit and month."""
    return _by_unit_and_month(_unit_day_sales(spark, sf, _unit_texts(SALES_COLUMNS)), SALES_COLUMNS)


@query(
    _SALES_VIEWS,
    _SALES_SQL
    + """
        SELECT manager, renting_type, year, month, sale_status, lead_band, stay_band, ytd, in_target,
               count(*) AS unit_days, count(reservation) AS sold,
               CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
               CAST(sum(CAST(target_rate AS DECIMAL(18,2))) AS DOUBLE) AS target,
               CAST(sum(CAST(current_rate AS DECIMAL(18,2))) AS DOUBLE) AS listed,
               CAST(sum(lead_days) AS BIGINT) AS lead_days, CAST(sum(target_occupancy) AS BIGINT) AS target_occupancy,
               min(first_booking) AS first_booking, max(last_sold_day) AS last_sold_day,
               min(first_sold_day) AS first_sold_day, count(channel) AS with_channel,
               count(name) AS named, CAST(sum(bedrooms_number) AS BIGINT) AS bedrooms,
               CAST(sum(target_min_stay) AS BIGINT) AS target_min_stay,
               CAST(sum(current_min_stay) AS BIGINT) AS current_min_stay,
               CAST(sum(booking_year_month) AS BIGINT) AS booking_year_month,
               CAST(sum(holiday_days) AS BIGINT) AS holiday_days, CAST(sum(is_future) AS BIGINT) AS future_days,
               count(*) FILTER (season_name = 'HIGH') AS high_days, count(*) FILTER (l7d = 'L7D') AS l7d_days,
               count(*) FILTER (week = 'S-1') AS last_week_days, count(*) FILTER (mtd = 'MTD') AS mtd_days,
               max(stay_adjusted_day) AS stay_adjusted_day
        FROM finished GROUP BY ALL""",
)
def unit_day_sales_by_month(spark, sf):
    """Unit-day sales over the whole history, summed by month and band."""

    def money(name):
        return F.sum(F.col(name).cast("decimal(18,2)"))

    rows = _unit_day_sales(spark, sf)
    return rows.groupBy(
        "manager", "renting_type", "year", "month", "sale_status", "lead_band", "stay_band", "ytd", "in_target"
    ).agg(
        F.count(F.lit(1)).alias("unit_days"),
        F.count("reservation").alias("sold"),
        money("price").alias("revenue"),
        money("target_rate").alias("target"),
        money("current_rate").alias("listed"),
        F.sum("lead_days").alias("lead_days"),
        F.sum("target_occupancy").alias("target_occupancy"),
        F.min("first_booking").alias("first_booking"),
        F.max("last_sold_day").alias("last_sold_day"),
        F.min("first_sold_day").alias("first_sold_day"),
        F.count("channel").alias("with_channel"),
        F.count("name").alias("named"),
        F.sum("bedrooms_number").alias("bedrooms"),
        F.sum("target_min_stay").alias("target_min_stay"),
        F.sum("current_min_stay").alias("current_min_stay"),
        F.sum("booking_year_month").alias("booking_year_month"),
        F.sum("holiday_days").alias("holiday_days"),
        F.sum("is_future").alias("future_days"),
        F.count_if(F.col("season_name") == "HIGH").alias("high_days"),
        F.count_if(F.col("l7d") == "L7D").alias("l7d_days"),
        F.count_if(F.col("week") == "S-1").alias("last_week_days"),
        F.count_if(F.col("mtd") == "MTD").alias("mtd_days"),
        F.max("stay_adjusted_day").alias("stay_adjusted_day"),
    )
