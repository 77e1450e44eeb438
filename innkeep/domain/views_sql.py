"""SQL twins of ``views``, for the comparison engine (DuckDB)."""

from __future__ import annotations

from collections.abc import Sequence

AS_OF = "DATE '1998-06-15'"

HOUSE = (
    "id, name, location_name, bedrooms_number, bathrooms_number, condo_type_name, condo_type_group_name, manager"
)
HOUSE_FIELDS = ", ".join(f"'{c}': {c}" for c in HOUSE.split(", "))


def folded(name: str) -> str:
    """Text without case, accents and trailing blanks."""
    return f"strip_accents(lower(rtrim({name})))"


# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[str, str]] = {
    "units": (
        "",
        """
        SELECT c_custkey AS id, c_name AS name, n_name AS location_name,
               1 + c_custkey % 6 AS bedrooms_number, 1 + c_custkey % 4 AS bathrooms_number,
               'TYPE ' || c_nationkey AS condo_type_name,
               'GROUP ' || n_regionkey AS condo_type_group_name,
               2 + c_custkey % 9 AS max_adults,
               CASE WHEN c_acctbal < 0 THEN 'NON-RENTING' ELSE 'RENTING' END AS renting_type,
               c_mktsegment AS manager, c_acctbal AS balance
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "listed_units": ("units", "SELECT * FROM units WHERE balance >= -500"),
    "unit_history": (
        "units",
        """
        SELECT *, TIMESTAMP '1998-06-13 05:00:00' AS load_time FROM units
        UNION ALL
        SELECT * REPLACE (name || CASE WHEN balance > 9500 THEN ' II' ELSE '' END AS name), TIMESTAMP '1998-06-14 05:00:00' AS load_time
        FROM units WHERE balance >= 0
        """,
    ),
    "reservations": (
        "",
        """
        SELECT o_orderkey AS id, o_orderkey AS confirmation_id, o_custkey AS unit_id,
               o_custkey + 1000 AS client_id,
               1 + o_orderkey % 8 AS occupants, o_orderkey % 3 AS occupants_small,
               'guest' || o_orderkey || '@example.com' AS email,
               'Guest' AS first_name, CAST(o_orderkey AS VARCHAR) AS last_name,
               1 + o_orderkey % 9 AS days_number,
               o_orderstatus AS maketype_description, o_orderpriority AS type_name,
               CAST(CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 5 ELSE 8 END AS BIGINT) AS status_code,
               CAST(CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 5 ELSE 8 END AS BIGINT) AS status_id,
               o_totalprice AS price_nightly, o_totalprice AS price_total,
               CAST(o_orderdate AS DATE) - CAST(o_orderkey % 200 AS INTEGER) AS creation_date,
               CAST(o_orderdate AS DATE) AS startdate,
               CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 9 AS INTEGER) AS enddate,
               CAST(o_orderdate AS DATE) AS last_updated,
               c_mktsegment AS manager
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        """,
    ),
    "price_days": (
        "",
        """
        SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS season, l_extendedprice AS price,
               l_tax AS extra, l_discount AS discount, l_quantity AS original_cost,
               l_orderkey AS reservation_id,
               CAST(DATE '1998-06-13' + CAST(l_linenumber % 2 AS INTEGER) AS TIMESTAMP) AS data_price,
               'loader' AS manager
        FROM lineitem
        """,
    ),
    "mirror_units": (
        "",
        "SELECT c_custkey AS from_id, c_custkey + 1 AS to_id FROM customer WHERE c_acctbal < -900",
    ),
    "booking_patches": (
        "",
        """
        SELECT o_orderkey AS id, DATE '1995-01-01' AS creation_date
        FROM orders WHERE o_totalprice > 499000
        """,
    ),
    "target_rates": (
        "",
        """
        SELECT id_unit, c_mktsegment AS manager, date, season, rate, min_stay
        FROM (SELECT l_suppkey AS id_unit, CAST(l_shipdate AS DATE) AS date,
                     max(l_returnflag) AS season, max(l_extendedprice) AS rate,
                     CAST(min(l_linenumber) AS BIGINT) AS min_stay
              FROM lineitem GROUP BY ALL)
        JOIN customer ON id_unit = c_custkey
        """,
    ),
    "current_prices": (
        "",
        """
        SELECT id_unit, c_mktsegment AS manager, date, season, rate, min_stay
        FROM (SELECT l_partkey AS id_unit, CAST(l_shipdate AS DATE) AS date,
                     max(l_returnflag) AS season, max(l_extendedprice) AS rate,
                     CAST(min(l_linenumber) AS BIGINT) AS min_stay
              FROM lineitem GROUP BY ALL)
        JOIN customer ON id_unit = c_custkey
        """,
    ),
    "seasons": (
        "reservations",
        """
        SELECT manager, startdate AS date, count(*) AS occupancy, max(type_name) AS holiday_name,
               max(days_number) AS holiday_days, min(status_id) AS holiday_of_year,
               CASE WHEN month(startdate) IN (6, 7, 12) THEN 'HIGH' ELSE 'LOW' END AS season,
               strftime(startdate, '%m. %b') AS season_interval
        FROM reservations GROUP BY manager, startdate
        """,
    ),
    "adjusted_days": (
        "reservations",
        """
        SELECT strftime(startdate, '%d-%m-%Y') AS day_text, max(creation_date) AS adjusted_day
        FROM reservations GROUP BY startdate
        """,
    ),
    "sale_status": (
        "",
        """
        SELECT DISTINCT upper(o_orderpriority) AS type_name, 'Vendido ' || o_orderpriority AS status
        FROM orders WHERE o_orderpriority <> '5-LOW'
        """,
    ),
    "channels": (
        "",
        """
        SELECT DISTINCT o_orderpriority AS type_name, 'channel ' || left(o_orderpriority, 1) AS channel
        FROM orders
        """,
    ),
    "target_units": (
        "",
        "SELECT c_custkey AS id_unit, 'SIM' AS value FROM customer WHERE c_acctbal > 5000",
    ),
    "board_previous": (
        "reservations",
        """
        SELECT CAST(id AS VARCHAR) AS reservation, 'Unit ' || unit_id AS unit,
               startdate AS check_in_date, enddate AS check_out_date,
               enddate + 3 AS next_arrival, enddate AS cleaning_date
        FROM reservations WHERE status_id IN (4, 5)
        """,
    ),
    "board_current": (
        "reservations",
        """
        SELECT CAST(id AS VARCHAR) AS reservation,
               'Unit ' || (unit_id + CASE type_name WHEN '5-LOW' THEN 1 ELSE 0 END) AS unit,
               startdate + CASE type_name WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS check_in_date,
               enddate AS check_out_date,
               enddate + CASE type_name WHEN '2-HIGH' THEN 5 ELSE 3 END AS next_arrival,
               enddate + CASE type_name WHEN '1-URGENT' THEN 1 ELSE 0 END AS cleaning_date
        FROM reservations WHERE status_id IN (5, 8)
        """,
    ),
    "work_orders": (
        "",
        """
        SELECT 'House ' || source AS unit_name,
               CASE WHEN lang <> 'de'
                    THEN text || ' (' || upper(left(source, 1)) || substr(source, 2) || ') '
                    ELSE text END AS title,
               DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS opened,
               CAST(doc_id AS VARCHAR) AS id, lang AS processor_name,
               'status ' || lang AS status_name
        FROM documents
        """,
    ),
    "calendar": (
        "adjusted_days",
        f"""
        SELECT day, strftime(day, '%d-%m-%Y') AS day_text, year(day) AS year, month(day) AS month,
               year(day) * 100 + month(day) AS year_month,
               'Y-' || (1998 - year(day)) AS year_label, {AS_OF} AS today, adjusted_day,
               CASE WHEN adjusted_day < {AS_OF} THEN 'YTD' ELSE 'YTG' END AS ytd,
               CASE WHEN adjusted_day < {AS_OF} AND month(adjusted_day) = 6
                    THEN 'MTD' ELSE 'MTG' END AS mtd,
               CASE WHEN {AS_OF} - adjusted_day BETWEEN 1 AND 7 THEN 'L7D' ELSE '-' END AS l7d,
               CASE WHEN {AS_OF} - adjusted_day BETWEEN 1 AND 7 THEN 'S'
                    WHEN {AS_OF} - adjusted_day BETWEEN 8 AND 14 THEN 'S-1' ELSE '-' END AS week
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-30',
                                                 INTERVAL 1 DAY)) AS DATE) AS day)
        LEFT JOIN adjusted_days ON strftime(day, '%d-%m-%Y') = day_text
        """,
    ),
    "sales": (
        "reservations price_days mirror_units booking_patches",
        """
        SELECT r.id, r.confirmation_id, coalesce(m.to_id, r.unit_id) AS unit_id, r.client_id,
               r.occupants, r.occupants_small, r.email, r.first_name, r.last_name, r.days_number,
               r.maketype_description, r.type_name, r.status_code, r.status_id, r.price_nightly,
               r.price_total, coalesce(b.creation_date, r.creation_date) AS creation_date,
               r.startdate, r.enddate, r.last_updated, r.manager,
               p.date, p.season, p.price, p.extra, p.discount, p.original_cost, p.reservation_id,
               p.data_price
        FROM reservations r
        LEFT JOIN (SELECT * FROM price_days
                   QUALIFY data_price = max(data_price) OVER (PARTITION BY reservation_id)) p
               ON r.id = p.reservation_id
        LEFT JOIN mirror_units m ON r.unit_id = m.from_id
        LEFT JOIN booking_patches b ON r.id = b.id
        WHERE r.status_id IN (4, 5, 6, 7)
        """,
    ),
    "houses": (
        "listed_units unit_history reservations",
        f"""
        SELECT DISTINCT known.*, coalesce(
                   (SELECT max(l.renting_type) FROM listed_units l
                    WHERE l.id = known.id AND {folded("l.manager")} = {folded("known.manager")}),
                   'NON-RENTING') AS renting_type
        FROM (
            SELECT {HOUSE} FROM listed_units
            UNION ALL BY NAME
            SELECT unnest(last_known)
            FROM (SELECT arg_max({{{HOUSE_FIELDS}}}, load_time) AS last_known FROM unit_history GROUP BY id)
            UNION ALL BY NAME
            SELECT unit_id AS id, min(manager) AS manager FROM reservations
            WHERE unit_id NOT IN (SELECT id FROM listed_units)
            GROUP BY unit_id, {folded("manager")}
        ) known
        """,
    ),
    "spine_units": (
        "listed_units reservations",
        f"""
        SELECT id, coalesce(min(manager) FILTER (listed), min(manager)) AS manager
        FROM (SELECT id, manager, true AS listed FROM listed_units WHERE renting_type = 'RENTING'
              UNION ALL SELECT unit_id, manager, false FROM reservations)
        GROUP BY id, {folded("manager")}
        """,
    ),
}


def with_views(names: Sequence[str], body: str) -> str:
    """``body`` preceded by the named views and whatever they read."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        for other in VIEWS[name][0].split():
            need(other)
        ordered.append(name)

    for name in names:
        need(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered)
    body = body.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    return f"WITH {ctes}{joiner}{body[5:] if joiner == ',\n' else body}"
