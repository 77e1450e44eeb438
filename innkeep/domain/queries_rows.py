"""Queries of row selection, joins, sets and quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from innkeep.domain import views as V
from innkeep.domain.registry import query
from innkeep.functions import dates as D
from innkeep.operators import columns as P, joins as J, quality as Q, rows as R
from innkeep.operators.nested import flatten
from innkeep.session import stored


@query(
    "",
    """SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_row(spark, sf):
    """Most recently loaded row per id."""
    loads = V.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return R.latest_row(loads, ["user_id"], "ts", ["event_id"])


@query(
    "",
    """SELECT user_id, event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def first_by_order(spark, sf):
    """First row per key in an explicit order."""
    rows = V.table(spark, sf, "events")
    return R.first_by(rows, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id"
    )


@query(
    "price_days",
    """SELECT reservation_id, date, price, data_price FROM price_days
    QUALIFY data_price = max(data_price) OVER (PARTITION BY reservation_id)""",
)
def latest_snapshot(spark, sf):
    """All rows of each reservation's latest price load."""
    rows = V.price_days(spark, sf).select("reservation_id", "date", "price", "data_price")
    return R.latest_snapshot(rows, ["reservation_id"], "data_price")


@query("reservations", "SELECT DISTINCT unit_id, manager FROM reservations")
def distinct_keys(spark, sf):
    """Distinct key list."""
    return V.reservations(spark, sf).select("unit_id", "manager").distinct()


@query(
    "reservations",
    """SELECT unit_id, manager, min(creation_date) AS first_booking, max(startdate) AS last_sold_day,
           min(startdate) AS first_sold_day
    FROM reservations WHERE status_id <> 8 GROUP BY unit_id, manager""",
)
def first_sale(spark, sf):
    """First booking, first and last sold day per unit and manager."""
    sold = V.reservations(spark, sf).where("status_id <> 8")
    return R.first_sale(sold, ["unit_id", "manager"], "creation_date", "startdate")


@query(
    "listed_units reservations",
    """SELECT id, manager FROM listed_units
    WHERE renting_type = 'RENTING'
      AND id NOT IN (SELECT unit_id FROM reservations WHERE startdate >= DATE '2001-01-01')""",
)
def pending_units(spark, sf):
    """Rented-out units not loaded yet (one anti join)."""
    from innkeep.plans.rates import pending_targets

    loaded = V.bookings(spark, sf).where("startdate >= date'2001-01-01'")
    return pending_targets(
        V.listed_units(spark, sf), loaded.select(F.col("unit_id").alias("id_unit"))
    )


@query(
    "listed_units reservations",
    """SELECT id, manager FROM listed_units
    WHERE id NOT IN (SELECT unit_id FROM reservations WHERE startdate >= DATE '2001-01-01')
    ORDER BY balance DESC, id LIMIT 25""",
)
def next_pending_units(spark, sf):
    """The next batch of pending units in priority order (a top-k)."""
    loaded = V.bookings(spark, sf).where("startdate >= date'2001-01-01'")
    done = loaded.select(F.col("unit_id").alias("id"))
    units = V.listed_units(spark, sf)
    return R.next_pending(units, done, ["id"], 25, [F.desc("balance"), "id"]).select("id", "manager")


@query(
    "price_days reservations",
    """SELECT reservation_id, date, price FROM price_days
    WHERE reservation_id IN (SELECT id FROM reservations WHERE status_id IN (4, 5, 6, 7))""",
)
def prices_of_active(spark, sf):
    """Detail rows of a key set, by semi join instead of key batches."""
    keys = V.bookings(spark, sf).where(F.col("status_id").isin(4, 5, 6, 7))
    prices = V.price_days(spark, sf).select("reservation_id", "date", "price")
    return R.only_keys(prices, keys.select(F.col("id").alias("reservation_id")), ["reservation_id"])


@query(
    "units sale_status reservations",
    """SELECT r.id, r.unit_id, u.name, u.location_name, s.status
    FROM reservations r LEFT JOIN units u ON r.unit_id = u.id AND r.manager = u.manager
    LEFT JOIN sale_status s ON lower(rtrim(r.type_name)) = lower(rtrim(s.type_name))""",
)
def lookups(spark, sf):
    """Left lookups on (unit, manager) and on a text key without regard to case."""
    rows = V.reservations(spark, sf).select("id", "unit_id", "manager", "type_name")
    rows = J.lookup(
        rows,
        V.units(spark, sf),
        {"unit_id": "id", "manager": "manager"},
        {"name": "name", "location_name": "location_name"},
        ("manager",),
    )
    rows = J.lookup(
        rows, V.sale_status(spark, sf), {"type_name": "type_name"}, {"status": "status"}, ("type_name",)
    )
    return rows.drop("manager", "type_name")


@query(
    "calendar reservations",
    """SELECT r.id, k.year_month AS booked_year_month, k.ytd AS booked_ytd, k.week AS booked_week,
           l.year_label AS stay_year_label, l.adjusted_day AS stay_adjusted_day
    FROM reservations r LEFT JOIN calendar k ON r.creation_date = k.day
    LEFT JOIN calendar l ON r.startdate = l.day""",
)
def two_calendars(spark, sf):
    """The calendar joined twice: on the booking day and on the stay day."""
    from innkeep.domain.queries_marts import calendar_of

    # stored, so that Spark knows it is small before any reservation moves
    calendar = stored(calendar_of(spark, sf), "calendar")
    rows = V.bookings(spark, sf).select("id", "creation_date", "startdate")
    rows = J.lookup(
        rows,
        calendar,
        {"creation_date": "day"},
        {"booked_year_month": "year_month", "booked_ytd": "ytd", "booked_week": "week"},
    )
    rows = J.lookup(
        rows,
        calendar,
        {"startdate": "day"},
        {"stay_year_label": "year_label", "stay_adjusted_day": "adjusted_day"},
    )
    return rows.drop("creation_date", "startdate")


@query(
    "reservations price_days",
    """SELECT r.id, p.date, p.price FROM reservations r LEFT JOIN price_days p ON r.id = p.reservation_id""",
)
def reservation_details(spark, sf):
    """Left join of a one-to-many detail."""
    heads = V.bookings(spark, sf).select("id")
    return J.left_details(
        heads, V.price_days(spark, sf), {"id": "reservation_id"}, {"date": "date", "price": "price"}
    )


@query(
    "listed_units reservations",
    """SELECT id, manager FROM listed_units WHERE renting_type = 'RENTING'
    UNION SELECT unit_id, manager FROM reservations""",
)
def unit_list(spark, sf):
    """Distinct union of listed and booked units."""
    from innkeep.plans.dimensions import spine_units

    return spine_units(V.listed_units(spark, sf), V.reservations(spark, sf))


@query(
    "",
    """SELECT o_orderkey AS id, o_orderpriority AS kind, NULL::DOUBLE AS price FROM orders
    UNION ALL SELECT l_orderkey, NULL, l_extendedprice FROM lineitem""",
)
def union_ragged(spark, sf):
    """Union of tables with different columns."""
    a = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"))
    b = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price")
    )
    return R.union_ragged([a, b])


@query(
    "board_previous board_current",
    "SELECT unit FROM board_previous INTERSECT SELECT unit FROM board_current",
)
def units_to_register(spark, sf):
    """Units named by both lists."""
    from innkeep.plans.operations import units_to_register as both

    return both(V.board_previous(spark, sf), V.board_current(spark, sf))


@query(
    "board_previous board_current",
    """SELECT reservation, unit FROM board_previous
    WHERE reservation NOT IN (SELECT reservation FROM board_current)""",
)
def only_in_previous(spark, sf):
    """Rows whose key the other snapshot lacks."""
    from innkeep.functions.text import norm_id

    previous = V.board_previous(spark, sf).withColumn("reservation", norm_id("reservation"))
    return R.not_in_other(previous, V.board_current(spark, sf), ["reservation"]).select(
        "reservation", "unit"
    )


@query(
    "reservations",
    """WITH base AS (SELECT * FROM reservations WHERE startdate < DATE '2001-05-01'),
    n AS (SELECT count(*) AS new_rows, sum(CAST(price_nightly AS DECIMAL(18,2))) AS new_sum FROM reservations),
    b AS (SELECT count(*) AS base_rows, sum(CAST(price_nightly AS DECIMAL(18,2))) AS base_sum FROM base)
    SELECT new_rows, base_rows, CAST(new_sum AS DOUBLE) AS new_sum, CAST(base_sum AS DOUBLE) AS base_sum,
           true AS columns_ok,
           new_rows >= base_rows AND (new_rows - base_rows) * 100 <= base_rows * 5 AS rows_ok,
           abs(new_sum - base_sum) * 10 <= abs(base_sum) AS sum_ok,
           new_rows >= base_rows AND (new_rows - base_rows) * 100 <= base_rows * 5
               AND abs(new_sum - base_sum) * 10 <= abs(base_sum) AS passed
    FROM n, b""",
)
def quality_gate(spark, sf):
    """Checks of a load against the published table, in one pass over both."""
    from innkeep.plans.reservations import reservation_quality_gate

    new = V.bookings(spark, sf)
    return reservation_quality_gate(new, new.where("startdate < date'2001-05-01'"))


@query(
    "board_previous board_current",
    """WITH n AS (SELECT count(*) AS new_rows FROM board_current), b AS (SELECT count(*) AS base_rows FROM board_previous)
    SELECT new_rows, base_rows, 0.0::DOUBLE AS new_sum, 0.0::DOUBLE AS base_sum, false AS columns_ok,
           new_rows >= base_rows AND (new_rows - base_rows) * 100 <= base_rows * 5 AS rows_ok,
           true AS sum_ok, false AS passed
    FROM n, b""",
)
def quality_gate_columns(spark, sf):
    """Gate over tables whose columns differ and which lack the summed column."""
    current = V.board_current(spark, sf).withColumn("note", F.lit(""))
    return Q.quality_gate(current, V.board_previous(spark, sf), "price_nightly")


@query(
    "",
    """SELECT count(*) AS n_rows, count(*) FILTER (CAST(o_orderdate AS DATE) = DATE '1998-06-15') AS n_day
    FROM orders""",
)
def day_count(spark, sf):
    """Row count of a table and of one day."""
    from innkeep.sources.tables import counts_for_day

    orders = V.table(spark, sf, "orders")
    return counts_for_day(orders, "o_orderdate", str(V.AS_OF))


@query(
    "reservations",
    """SELECT count(DISTINCT confirmation_id) AS reservations, count(DISTINCT unit_id) AS units,
           max(length(email)) AS longest_email FROM reservations""",
)
def distinct_counts(spark, sf):
    """Exact distinct counts and the longest text."""
    return V.bookings(spark, sf).agg(
        F.count_distinct("confirmation_id").alias("reservations"),
        F.count_distinct("unit_id").alias("units"),
        F.max(F.length("email")).alias("longest_email"),
    )


@query(
    "",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def key_uniqueness(spark, sf):
    """Keys that occur more than once."""
    return Q.duplicate_keys(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _profile_sql() -> str:
    columns = {
        "id": "bigint",
        "name": "text",
        "location_name": "text",
        "renting_type": "text",
        "manager": "text",
        "balance": "double",
        "note": "text",
    }
    selects = []
    for name, kind in columns.items():
        length = f"coalesce(max(length({name})), 0)" if kind == "text" else (
            f"max(length(CAST({name} AS VARCHAR)))"
        )
        storage = (
            f"CASE WHEN {length} <= 255 THEN 'VARCHAR(255)' WHEN {length} <= 1024 THEN 'VARCHAR(1024)' "
            f"WHEN {length} <= 4096 THEN 'VARCHAR(4096)' ELSE 'MEDIUMTEXT' END"
            if kind == "text"
            else f"'{kind.upper()}'"
        )
        selects.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS logical_type, count(*) AS n_rows, "
            f"count(*) - count({name}) AS n_nulls, CAST({length} AS BIGINT) AS max_length, "
            f"{storage} AS storage_type FROM t"
        )
    return (
        "WITH t AS (SELECT id, name, location_name, renting_type, manager, balance, "
        "CASE WHEN balance < 0 THEN repeat('x', 300) END AS note FROM units) "
        + " UNION ALL ".join(selects)
    )


@query("units", _profile_sql())
def column_profile(spark, sf):
    """Type, nulls, longest value and storage width of every column."""
    rows = V.units(spark, sf).withColumn("note", F.when(F.col("balance") < 0, F.repeat(F.lit("x"), 300)))
    return Q.column_profile(
        rows.select("id", "name", "location_name", "renting_type", "manager", "balance", "note")
    )


@query(
    "reservations",
    """SELECT id, unit_id, startdate FROM reservations ORDER BY startdate, id""",
)
def sorted_by_arrival(spark, sf):
    """Sort by arrival."""
    return V.bookings(spark, sf).select("id", "unit_id", "startdate").orderBy("startdate", "id")


@query(
    "reservations",
    """SELECT id AS id_a, id AS reservation_id, startdate AS startdate, unit_id AS unit_id
    FROM reservations""",
)
def drop_clashing(spark, sf):
    """Columns of the right side that the left already has are dropped."""
    rows = V.bookings(spark, sf)
    left = rows.select(F.col("id").alias("id_a"), "startdate", "unit_id")
    right = rows.select(
        F.col("id").alias("reservation_id"), F.col("enddate").alias("StartDate"), "unit_id"
    )
    side = P.drop_clashing(right, left)
    return left.join(side, F.col("id_a") == F.col("reservation_id"))


@query(
    "listed_units",
    """SELECT id AS "unit.id", name AS "unit.name", location_name AS "unit.place.location_name", manager
    FROM listed_units""",
)
def flatten_structs(spark, sf):
    """Nested objects to dotted columns."""
    rows = V.listed_units(spark, sf).select(
        F.struct("id", "name", F.struct("location_name").alias("place")).alias("unit"), "manager"
    )
    return flatten(rows)


@query(
    "reservations",
    """SELECT id, startdate >= DATE '1998-06-15' AS upcoming, startdate > DATE '1998-06-15' AS later,
           CASE WHEN startdate >= DATE '1998-06-15' THEN 1::BIGINT ELSE 0 END AS is_future,
           startdate BETWEEN DATE '1998-06-10' AND DATE '1998-09-08' AS in_report,
           DATE '1998-06-15' + 547 AS price_horizon
    FROM reservations""",
)
def relative_to_today(spark, sf):
    """As-of comparisons, report window and price horizon."""
    lo, hi = D.report_window(V.AS_OF)
    start, today = F.col("startdate"), F.lit(V.AS_OF)
    return V.bookings(spark, sf).select(
        "id",
        (start >= today).alias("upcoming"),
        (start > today).alias("later"),
        F.when(start >= today, 1).otherwise(0).alias("is_future"),
        start.between(F.lit(lo), F.lit(hi)).alias("in_report"),
        F.date_add(today, D.PRICE_DAYS_FORWARD).alias("price_horizon"),
    )


# Spellings of one name each, as a Unicode collation sees them.
SPELLINGS = (
    ("Nguyễn Thị", "NGUYEN THI ", "nguyễn thi"),
    ("Straße", "STRASSE", "strasse  "),
    ("Ελλάδα", "ΕΛΛΑΔΑ", "ελλαδα "),
    ("Москва", "МОСКВА ", "москва"),
    ("Ångström", "angstrom", "ANGSTRÖM "),
    ("Õunapuu", "ounapuu", "OUNAPUU"),
)

_SPELLED = f"""SELECT c_custkey AS unit_id, c_custkey % {len(SPELLINGS)} AS name_no,
           ([{", ".join("[" + ", ".join(f"'{x}'" for x in names) + "]" for names in SPELLINGS)}]
            )[1 + c_custkey % {len(SPELLINGS)}][1 + (c_custkey // 10) % 3] AS owner
    FROM customer"""


def _spelled(spark, sf):
    names = F.array(*[F.array(*map(F.lit, x)) for x in SPELLINGS])
    key = F.col("c_custkey")
    owner = F.get(F.get(names, (key % len(SPELLINGS)).cast("int")), (F.floor(key / 10) % 3).cast("int"))
    return V.table(spark, sf, "customer").select(key.alias("unit_id"), owner.alias("owner"))


@query(
    "",
    f"""WITH spelled AS ({_SPELLED})
    SELECT min(owner) AS owner, count(DISTINCT owner) AS spellings, count(*) AS n_rows FROM spelled GROUP BY name_no""",
)
def distinct_names(spark, sf):
    """Names that differ in case, accents and trailing blanks only, in several scripts."""
    from innkeep.operators.rows import distinct_collated

    return distinct_collated(_spelled(spark, sf), ["owner"])


@query(
    "",
    f"""WITH spelled AS ({_SPELLED})
    SELECT unit_id, owner, first_unit FROM spelled
    JOIN (SELECT name_no, min(unit_id) AS first_unit FROM spelled GROUP BY name_no) USING (name_no)""",
)
def lookup_by_name(spark, sf):
    """Each unit with the first unit of its owner, however the owner is spelled."""
    from innkeep.functions.text import collated
    from innkeep.operators.joins import lookup_collated

    units = _spelled(spark, sf)
    owners = units.groupBy(collated("owner").alias("k")).agg(F.min("owner").alias("name"), F.min("unit_id").alias("first_unit"))
    return lookup_collated(units, owners, {"owner": "name"}, {"first_unit": "first_unit"})
