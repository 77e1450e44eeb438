"""Queries of the operators on landed documents.

The documents are built from table rows, one per row, and landed in the shared
folder first.  The SQL they are checked against never sees JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from innkeep.domain import views as V
from innkeep.domain.registry import query
from innkeep.operators import cleaning as C, nested as N
from innkeep.plans import dimensions, occupancy, operations, rates, reservations as RP
from innkeep.session import stored
from innkeep.sources.sheets import grid_ids, read_grid


def _bookings(spark, sf) -> DataFrame:
    """Reservations over all tasks: building documents is the slow part, and the
    test tables come as one file each."""
    return V.bookings(spark, sf).repartition("id")


def _items(spark, sf) -> DataFrame:
    return V.table(spark, sf, "lineitem").repartition("l_orderkey", "l_partkey")


def _us(c: str) -> Column:
    return F.date_format(c, "MM/dd/yyyy")


def _by_type(values: dict[str, Column], default: Column) -> Column:
    out = None
    for kind, value in values.items():
        hit = F.col("type_name") == kind
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


# -- reservation pages --------------------------------------------------------


def _pages(spark, sf) -> DataFrame:
    """One page per reservation; cancelled ones also appear on a second, later
    page with another price.  The page holding them has either shape."""
    rows = _bookings(spark, sf)
    price = _by_type(
        {"1-URGENT": F.lit("abc"), "5-LOW": F.lit("nan")},
        F.col("price_nightly").cast("decimal(18,2)").cast("string"),
    )
    created = F.concat(F.date_format("creation_date", "MM/dd/yyyy"), F.lit(" 10:30:00 EST"))
    updated = F.concat(F.date_format("last_updated", "yyyy-MM-dd"), F.lit(" 23:15:00"))

    def record(price_text: Column) -> Column:
        return F.struct(
            F.col("id"),
            F.col("confirmation_id"),
            F.col("unit_id"),
            F.when(F.col("type_name") == "2-HIGH", "None").otherwise(F.col("email")).alias("email"),
            price_text.alias("price_nightly"),
            created.alias("creation_date"),
            updated.alias("last_updated"),
            _us("startdate").alias("startdate"),
            F.when(F.col("type_name") == "3-MEDIUM", "02/30/2025").otherwise(_us("enddate")).alias("enddate"),
        )

    first = rows.select(
        (2 * F.col("id")).alias("page"),
        F.lit(False).alias("again"),
        F.when(
            F.col("status_id") == 5,
            F.to_json(F.struct(F.struct(F.array(record(price)).alias("reservations")).alias("data"))),
        )
        .otherwise(F.to_json(F.struct(F.array(record(price)).alias("reservations"))))
        .alias("body"),
    )
    again = rows.where("status_id = 8").select(
        (2 * F.col("id") + 1).alias("page"),
        F.lit(True).alias("again"),
        F.to_json(F.struct(F.array(record(F.lit("1.00"))).alias("reservations"))).alias("body"),
    )
    return stored(first.unionByName(again), "pages")


@query(
    "reservations",
    """SELECT id, unit_id, confirmation_id,
           CASE WHEN type_name <> '2-HIGH' THEN email END AS email,
           CASE WHEN type_name NOT IN ('1-URGENT', '5-LOW')
                THEN CAST(CAST(price_nightly AS DECIMAL(18,2)) AS DOUBLE) END AS price_nightly,
           CAST(creation_date AS TIMESTAMP) + INTERVAL 15 HOUR + INTERVAL 30 MINUTE
               - CASE WHEN dst_c THEN INTERVAL 2 HOUR ELSE INTERVAL 3 HOUR END AS creation_date,
           timezone('America/Sao_Paulo', timezone('UTC', CAST(last_updated AS TIMESTAMP)
               + INTERVAL 23 HOUR + INTERVAL 15 MINUTE)) AS last_updated,
           startdate, CASE WHEN type_name <> '3-MEDIUM' THEN enddate END AS enddate,
           'main office' AS manager
    FROM (SELECT *, timezone('America/Sao_Paulo', timezone('UTC', CAST(creation_date AS TIMESTAMP)
                        + INTERVAL 15 HOUR + INTERVAL 30 MINUTE))
                    = CAST(creation_date AS TIMESTAMP) + INTERVAL 13 HOUR + INTERVAL 30 MINUTE AS dst_c
          FROM reservations)""",
)
def reservations_clean(spark, sf):
    """Reservations from pages: first occurrence kept, values typed."""
    clean = RP.reservations_clean(_pages(spark, sf), "main office")
    return clean.select(
        "id", "unit_id", "confirmation_id", "email", "price_nightly", "creation_date", "last_updated", "startdate",
        "enddate", "manager",
    )


# -- rejects ------------------------------------------------------------------


def _mixed_responses(spark, sf) -> DataFrame:
    """Responses of which only some are usable."""
    good = F.to_json(F.struct(F.struct("id", "confirmation_id").alias("data")))
    body = _by_type(
        {
            "1-URGENT": good,
            "2-HIGH": F.lit('{"status": {"code": "E0013", "description": "too many"}}'),
            "3-MEDIUM": F.lit('{"status": {"code": "SUCCESS"}, "data": {}}'),
            "4-NOT SPECIFIED": F.lit("<html>"),
        },
        F.lit(""),
    )
    docs = _bookings(spark, sf).select("id", "type_name", body.alias("body"))
    return stored(docs, "responses")


@query(
    "reservations",
    """SELECT CASE type_name WHEN '1-URGENT' THEN 'ok' WHEN '2-HIGH' THEN 'status E0013'
                WHEN '3-MEDIUM' THEN 'empty data' WHEN '4-NOT SPECIFIED' THEN 'invalid json'
                ELSE 'empty body' END AS reason, count(*) AS documents
    FROM reservations GROUP BY ALL""",
)
def document_tally(spark, sf):
    """Responses counted by outcome."""
    return N.tally(_mixed_responses(spark, sf), "body", "$.data")


@query(
    "reservations",
    """SELECT CASE type_name WHEN '2-HIGH' THEN 'status E0013' WHEN '3-MEDIUM' THEN 'empty data'
                WHEN '4-NOT SPECIFIED' THEN 'invalid json' ELSE 'empty body' END AS reason,
           count(*) AS documents
    FROM reservations WHERE type_name <> '1-URGENT' GROUP BY ALL""",
)
def reject_counts(spark, sf):
    """Unusable responses counted by reason."""
    _, rejects = N.split_documents(
        _mixed_responses(spark, sf), "body", "data struct<id: bigint>", "$.data"
    )
    return N.reject_counts(rejects)


@query(
    "reservations",
    "SELECT id, confirmation_id FROM reservations WHERE type_name = '1-URGENT'",
)
def usable_documents(spark, sf):
    """Usable responses, parsed."""
    good, _ = N.split_documents(
        _mixed_responses(spark, sf), "body", "data struct<id: bigint, confirmation_id: bigint>", "$.data"
    )
    return N.pick(good.drop("id"), "doc.data", ["id", "confirmation_id"]).select(
        "id", "confirmation_id"
    )


# -- envelopes ----------------------------------------------------------------


def _calendar_docs(spark, sf) -> DataFrame:
    """One calendar response per reservation, in five envelopes; some have a
    second period, an unreadable date, or nothing but an error."""
    one = F.format_string(
        '{"startdate": "%s", "enddate": "%s"}',
        _us("startdate"),
        F.when(F.col("status_id") == 4, "02/30/2025").otherwise(_us("enddate")),
    )
    two = F.format_string(
        '{"startdate": "%s", "enddate": "%s"}', _us("creation_date"), _us("startdate")
    )
    periods = F.concat(
        F.lit("["), one, F.when(F.col("status_id") == 8, F.concat(F.lit(", "), two)).otherwise(""), F.lit("]")
    )
    periods = F.when(F.col("days_number") == 1, "[]").otherwise(periods)
    body = _by_type(
        {
            "1-URGENT": periods,
            "2-HIGH": F.format_string('{"Response": {"data": {"blocked_period": %s}}}', periods),
            "3-MEDIUM": F.format_string('{"Response": {"data": %s}}', periods),
            "4-NOT SPECIFIED": F.format_string('{"data": %s}', periods),
        },
        F.format_string('{"data": {"blocked_period": %s}}', periods),
    )
    body = F.when(F.col("days_number") == 2, '{"status": {"code": "E0013"}}').otherwise(body)
    docs = _bookings(spark, sf).select("unit_id", body.alias("body"))
    return stored(docs, "calendars")


@query(
    "reservations",
    """SELECT unit_id, startdate, enddate FROM reservations WHERE days_number > 2 AND status_id <> 4
    UNION ALL
    SELECT unit_id, creation_date, startdate FROM reservations WHERE days_number > 2 AND status_id = 8""",
)
def envelope_unwrap(spark, sf):
    """Blocked periods out of five alternative envelopes."""
    return occupancy.blocked_periods(_calendar_docs(spark, sf))


@query(
    "units reservations",
    """WITH grid AS (
        SELECT id AS unit_id, CAST(unnest(generate_series(DATE '1994-01-01', DATE '2001-12-01',
                                                          INTERVAL 1 MONTH)) AS DATE) AS first_day
        FROM units WHERE renting_type = 'RENTING'),
    periods AS (
        SELECT unit_id, startdate AS s, enddate AS e FROM reservations WHERE days_number > 2 AND status_id <> 4
        UNION ALL
        SELECT unit_id, creation_date, startdate FROM reservations WHERE days_number > 2 AND status_id = 8),
    days AS (
        SELECT DISTINCT unit_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM periods),
    counts AS (
        SELECT unit_id, CAST(date_trunc('month', d) AS DATE) AS first_day, count(*) AS n,
               count(*) FILTER (d <= DATE '1998-06-15') AS past FROM days GROUP BY ALL)
    SELECT g.unit_id, strftime(g.first_day, '%Y-%m') AS month_str, coalesce(n, 0) AS days_occupied,
           coalesce(past, 0) AS days_occupied_past,
           round(coalesce(n, 0) / day(last_day(g.first_day)), 4) AS occupancy_rate
    FROM grid g LEFT JOIN counts c ON g.unit_id = c.unit_id AND g.first_day = c.first_day""",
)
def occupancy_from_calendars(spark, sf):
    """Monthly occupancy from calendar responses with long, overlapping periods."""
    units = V.units(spark, sf).select(F.col("id").alias("unit_id"), "renting_type")
    periods = occupancy.blocked_periods(_calendar_docs(spark, sf))
    rows = occupancy.monthly_occupancy(periods, units, range(1994, 2002), V.AS_OF)
    return rows.select("unit_id", "month_str", "days_occupied", "days_occupied_past", "occupancy_rate")


# -- fees ---------------------------------------------------------------------


def _fee_docs(spark, sf) -> DataFrame:
    """One fee document per line item.  Return flag and line status decide
    which sections it has and whether the fee section is one bare object."""
    items = _items(spark, sf)

    def fee(code: int, name: str, value: str, percent: str) -> Column:
        return F.format_string(
            f'{{"id": {code}, "name": "{name}", "value": "%s", "percent": "%s", '
            '"include_as_tax": 1, "taxable": "x"}',
            F.col(value).cast("decimal(18,2)").cast("string"),
            F.col(percent).cast("decimal(10,4)").cast("string"),
        )

    tax, cleaning = fee(7, "tax", "l_extendedprice", "l_tax"), fee(8, "cleaning", "l_quantity", "l_discount")
    several = F.concat(F.lit("["), tax, F.lit(", "), cleaning, F.lit("]"))
    section = (
        F.when(F.col("l_returnflag") == "A", several)
        .when(F.col("l_returnflag") == "R", tax)
        .otherwise("[]")
    )
    commission = F.when(
        F.col("l_linestatus") == "F",
        F.format_string(
            '{"management_commission_amount": "%s", "owner_commission_percent": "n/a"}',
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        ),
    ).otherwise("{}")
    body = F.format_string(
        '{"data": {"commission_information": %s, "taxes_and_fees": {"tax_fee": %s}}}', commission, section
    )
    return stored(items.select(F.col("l_orderkey").alias("confirmation_id"), body.alias("body")), "fees")


_FEE_ROWS = """fee_rows AS (
    SELECT l_orderkey AS confirmation_id, l_linestatus, l_extendedprice,
           unnest([{'t': 'tax_fee', 'i': 7, 'n': 'tax', 'v': l_extendedprice, 'p': l_tax},
                   {'t': 'tax_fee', 'i': 8, 'n': 'cleaning', 'v': l_quantity, 'p': l_discount}], recursive := true)
    FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT l_orderkey, l_linestatus, l_extendedprice, 'commission', NULL, 'Commission Summary', NULL, NULL
    FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus = 'F')"""


@query(
    "",
    f"""WITH {_FEE_ROWS}
    SELECT confirmation_id, t AS row_type, CAST(i AS BIGINT) AS fee_id, n AS name,
           CAST(CAST(v AS DECIMAL(18,2)) AS DOUBLE) AS value,
           CAST(CAST(p AS DECIMAL(10,4)) AS DOUBLE) AS percent,
           CAST(CASE WHEN t = 'tax_fee' THEN 1 END AS BIGINT) AS include_as_tax,
           CAST(NULL AS BIGINT) AS taxable,
           CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END
               AS management_commission_amount,
           CAST(NULL AS DOUBLE) AS management_commission_percent,
           CAST(NULL AS DOUBLE) AS owner_commission_amount, CAST(NULL AS DOUBLE) AS owner_commission_percent
    FROM fee_rows""",
)
def taxes_and_fees(spark, sf):
    """Fee and commission rows of fee documents."""
    return rates.taxes_and_fees(_fee_docs(spark, sf))


@query(
    "",
    """SELECT 'fees not a list' AS reason, count(*) AS documents FROM lineitem WHERE l_returnflag = 'R'""",
)
def fee_rejects(spark, sf):
    """Fee documents whose sections have the wrong shape."""
    judged = _fee_docs(spark, sf).withColumn("reason", N.fee_reject("body"))
    return N.reject_counts(judged.where("reason is not null"))


# -- nightly prices -------------------------------------------------------------


@query(
    "",
    """SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS season, l_extendedprice AS price,
           l_tax AS extra, CASE WHEN l_linestatus = 'F' THEN l_discount END AS discount,
           CAST(NULL AS DOUBLE) AS original_cost, l_orderkey AS reservation_id,
           TIMESTAMP '1998-06-15 02:00:00' AS data_price, 'main office' AS manager
    FROM lineitem WHERE l_returnflag <> 'R'""",
)
def price_days_explode(spark, sf):
    """Nightly prices of price documents; one has no days, one no id."""
    items = _items(spark, sf)
    day = F.struct(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"),
        F.col("l_returnflag").alias("season"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").cast("string").alias("extra"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount").cast("string"))
        .otherwise("free")
        .alias("discount"),
    )
    # returned items: no days when the line is finished, else no reservation id
    none = F.filter(F.array(day), lambda _: F.lit(False))
    days = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), none).otherwise(F.array(day))
    key = F.when((F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F"), F.col("l_orderkey"))
    body = F.to_json(
        F.struct(F.struct(key.alias("reservation_id"), days.alias("reservation_days")).alias("data"))
    )
    docs = stored(items.select(body.alias("body")), "price_documents")
    return RP.reservation_price_days(docs, V.load_time(), F.lit("main office"))


# -- rates ----------------------------------------------------------------------


def _rate_docs(spark, sf) -> DataFrame:
    """One rate response per property and load; delisted ones come back empty."""
    rate = F.struct(
        F.lit("06/15/1998").alias("date"),
        F.col("location_name").alias("season"),
        F.col("balance").cast("string").alias("rate"),
        F.col("max_adults").cast("string").alias("minStay"),
        F.struct(F.lit("BASE").alias("season"), F.lit("10").alias("rate")).alias("rate_type"),
    )
    body = F.when(F.col("balance") >= -500, F.to_json(F.struct(F.array(rate, rate).alias("data")))).otherwise(
        '{"data": []}'
    )
    docs = V.units(spark, sf).select(F.col("id").alias("unit_id"), "manager", "balance", body.alias("body"))
    return stored(docs, "rates")


_RATE_ROWS = """SELECT id AS id_unit, manager, '06/15/1998' AS date, location_name AS season,
           CAST(balance AS VARCHAR) AS rate, CAST(max_adults AS VARCHAR) AS "minStay",
           'BASE' AS "rate_type.season", '10' AS "rate_type.rate", CAST(NULL AS VARCHAR) AS "rate_type.minStay",
           TIMESTAMP '1998-06-15 02:00:00' AS data_price
    FROM listed_units, (VALUES (1), (2)) twice(n)"""


@query("listed_units", _RATE_ROWS + " WHERE id NOT IN (99999)")
def price_rows(spark, sf):
    """Price responses as flat rows, skipping units that are not priced."""
    return rates.price_rows(_rate_docs(spark, sf).drop("balance"), V.load_time(), (99999,))[0]


@query(
    "listed_units target_rates",
    f"""SELECT id_unit, manager, date, season, rate, "minStay" FROM (
        SELECT id_unit, manager, strftime(date, '%m/%d/%Y') AS date, season, CAST(rate AS VARCHAR) AS rate,
               CAST(min_stay AS VARCHAR) AS "minStay" FROM target_rates
        UNION ALL BY NAME
        ({_RATE_ROWS} WHERE renting_type = 'RENTING' AND id NOT IN (SELECT id_unit FROM target_rates)))""",
)
def target_rates(spark, sf):
    """Target rates: the sheet, plus every unit it does not cover."""
    sheet = V.target_rates(spark, sf).select(
        "id_unit",
        "manager",
        F.date_format("date", "MM/dd/yyyy").alias("date"),
        "season",
        F.col("rate").cast("string").alias("rate"),
        F.col("min_stay").cast("string").alias("minStay"),
    )
    docs = _rate_docs(spark, sf).drop("balance")
    rows = rates.target_rates(sheet, docs, V.listed_units(spark, sf), V.load_time())
    return rows.select("id_unit", "manager", "date", "season", "rate", "minStay")


# -- custom fields, names and values ----------------------------------------------


@query(
    "",
    """SELECT 42 + 0::BIGINT AS field_id, 'target' AS name, event_type AS value, event_id AS id_unit,
           'main office' AS manager, TIMESTAMP '1998-06-15 02:00:00' AS data_price
    FROM events WHERE event_type NOT IN ('error', 'view')""",
)
def custom_field_filter(spark, sf):
    """Custom-field responses reduced to one field."""
    wanted = F.struct(F.lit(42).alias("field_id"), F.lit("target").alias("name"), F.col("event_type").alias("value"))
    other = F.struct(F.lit(7).alias("field_id"), F.lit("other").alias("name"), F.lit("x").alias("value"))
    body = (
        F.when(F.col("event_type") == "error", "not json")
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.struct(F.array(other).alias("field")).alias("data"))))
        .otherwise(F.to_json(F.struct(F.struct(F.array(other, wanted).alias("field")).alias("data"))))
    )
    docs = V.table(spark, sf, "events").select(
        F.col("event_id").alias("unit_id"), F.lit("main office").alias("manager"), body.alias("body")
    )
    return rates.unit_filter_flag(stored(docs, "fields"), 42, V.load_time())[0]


def _pairs(spark, sf) -> DataFrame:
    """Name/value lists with a repeated name."""
    text = F.col("value").cast("string")
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    return V.table(spark, sf, "events").select(
        "event_id",
        F.array(
            pair("code", F.lit("first")),
            pair("kind", F.col("event_type")),
            pair("code", F.get_json_object("props", "$.k")),
            F.struct(F.col("event_type").alias("name"), text.alias("value")),
        ).alias("pairs"),
    )


@query(
    "",
    """SELECT event_id, props->>'$.k' AS code, event_type AS kind,
           CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR) END AS click,
           CAST(NULL AS VARCHAR) AS missing, CAST(3 AS BIGINT) AS names
    FROM events""",
)
def name_value_pivot(spark, sf):
    """Name/value lists as columns; the last duplicate wins."""
    counted = _pairs(spark, sf).withColumn("names", F.size(N.name_value_map("pairs")))
    return N.name_value_columns(counted, "pairs", ["code", "kind", "click", "missing"])


# -- flattening ---------------------------------------------------------------------


@query(
    "",
    """SELECT l_orderkey AS confirmation_id, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS code,
           l_suppkey AS result_id, 1::BIGINT AS past_count
    FROM lineitem WHERE l_returnflag <> 'N'
    UNION ALL
    SELECT l_partkey, NULL, l_suppkey, 1 FROM lineitem WHERE l_returnflag <> 'N'""",
)
def flatten_records(spark, sf):
    """Rows of a nested list with carried parent fields."""
    item = F.struct(
        F.col("l_orderkey").alias("confirmation_id"),
        F.struct(F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("code")).alias("state"),
    )
    bare = F.struct(
        F.col("l_partkey").alias("confirmation_id"),
        F.struct(F.lit(None).cast("string").alias("code")).alias("state"),
    )
    none = F.filter(F.array(item), lambda _: F.lit(False))
    groups = V.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("result_id"),
        F.lit(1).alias("past_count"),
        F.struct(
            F.when(F.col("l_returnflag") == "N", none).otherwise(F.array(item, bare)).alias("reservation")
        ).alias("reservations"),
    )
    rows = N.explode_path(groups, "reservations.reservation", ["result_id", "past_count"])
    return N.flatten(rows, sep="_", max_level=1).withColumnRenamed("state_code", "code")


@query(
    "units",
    """SELECT id, '{"beds":' || bedrooms_number || ',"baths":' || bathrooms_number || '}' AS size,
           '["' || manager || '","' || renting_type || '"]' AS tags, name FROM units""",
)
def nested_to_json(spark, sf):
    """Nested values as JSON text."""
    rows = V.units(spark, sf).select(
        "id",
        F.struct(F.col("bedrooms_number").alias("beds"), F.col("bathrooms_number").alias("baths")).alias("size"),
        F.array("manager", "renting_type").alias("tags"),
        "name",
    )
    return C.nested_to_json(rows)


@query(
    "listed_units",
    """SELECT id, name, location_name AS "place.location_name",
           '[' || bedrooms_number || ',' || bathrooms_number || ']' AS rooms,
           DATE '1998-01-01' + CAST(id % 100 AS INTEGER) AS since, manager || ' 1998-01-01' AS note
    FROM listed_units""",
)
def active_houses(spark, sf):
    """Property list flattened, date columns typed, lists as JSON."""
    import datetime as dt

    since = F.date_add(F.lit(dt.date(1998, 1, 1)), (F.col("id") % 100).cast("int"))
    rows = V.listed_units(spark, sf).select(
        "id",
        "name",
        F.struct("location_name").alias("place"),
        F.array("bedrooms_number", "bathrooms_number").alias("rooms"),
        F.date_format(since, "yyyy-MM-dd").alias("since"),
        F.concat("manager", F.lit(" 1998-01-01")).alias("note"),
    )
    return rates.active_houses(rows, ("since", "note"))


@query(
    "reservations",
    """SELECT id, CASE WHEN type_name <> '2-HIGH' THEN confirmation_id END AS confirmation_id,
           'https://example.com/' || id AS referrer_url, TIMESTAMP '1998-06-15 02:00:00' AS collected_at,
           manager
    FROM reservations WHERE type_name <> '1-URGENT'""",
)
def referrers(spark, sf):
    """Referring URLs of reservation responses."""
    info = F.struct(
        F.col("id"),
        F.when(F.col("type_name") == "2-HIGH", "none").otherwise(F.col("confirmation_id").cast("string")).alias("confirmation_id"),
        F.concat(F.lit("https://example.com/"), F.col("id").cast("string")).alias("referrer_url"),
    )
    body = F.when(F.col("type_name") == "1-URGENT", '{"data": {"reservation": []}}').otherwise(
        F.to_json(F.struct(F.struct(info.alias("reservation")).alias("data")))
    )
    docs = V.reservations(spark, sf).select("manager", body.alias("body"))
    return rates.referrers(stored(docs, "infos"), V.load_time())[0]


@query(
    "units",
    """SELECT manager, id, name, location_name, bedrooms_number, bathrooms_number, condo_type_name,
           condo_type_group_name, CASE WHEN balance > 0 THEN max_adults END AS max_adults, renting_type,
           TIMESTAMP '1998-06-15 02:00:00' AS load_time
    FROM units""",
)
def property_list(spark, sf):
    """Property responses as a typed list with manager and load time."""
    fields = [
        "name", "location_name", "condo_type_name", "condo_type_group_name", "renting_type",
    ]
    item = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("bedrooms_number").cast("double").cast("string").alias("bedrooms_number"),
        F.col("bathrooms_number"),
        F.when(F.col("balance") > 0, F.col("max_adults").cast("string")).otherwise("many").alias("max_adults"),
        *fields,
    )
    body = F.to_json(F.struct(F.struct(F.array(item).alias("property")).alias("data")))
    docs = stored(V.units(spark, sf).select("manager", body.alias("body")), "properties")
    return dimensions.property_list(docs, V.load_time())


@query(
    "work_orders",
    """SELECT DISTINCT id, unit_name, title, processor_name, status_name FROM work_orders
    WHERE status_name <> 'status es'""",
)
def work_order_rows(spark, sf):
    """Work orders out of responses; one status has none, one repeats them."""
    order = F.struct("id", "unit_name", "title", "processor_name", "status_name")
    twice = F.when(F.col("status_name") == "status fr", F.array(order, order)).otherwise(F.array(order))
    none = F.filter(F.array(order), lambda _: F.lit(False))
    orders = F.when(F.col("status_name") == "status es", none).otherwise(twice)
    body = F.to_json(
        F.struct(F.struct(F.struct(orders.alias("maintenance")).alias("maintenances")).alias("data"))
    )
    docs = stored(V.work_orders(spark, sf).select(body.alias("body")), "orders")
    return operations.work_order_rows(docs).select(
        "id", "unit_name", "title", "processor_name", "status_name"
    )


# -- grids ------------------------------------------------------------------------------


def _grid(spark, sf) -> DataFrame:
    """A sheet of customers: one header row, then rows of uneven length."""
    rows = V.table(spark, sf, "customer").select(
        (F.col("c_custkey") + 2).alias("row_no"),
        F.array_compact(
            F.array(
                F.col("c_custkey").cast("string"),
                F.col("c_name"),
                F.col("c_mktsegment"),
                F.when(F.col("c_acctbal") > 0, "paid"),
                F.when(F.col("c_acctbal") > 5000, "over"),
            )
        ).alias("cells"),
    )
    header = rows.agg(F.lit(1).cast("bigint").alias("row_no"), F.count(F.lit(1)).alias("n")).select(
        "row_no", F.array(F.lit("id "), F.lit("name"), F.lit(""), F.lit("name")).alias("cells")
    )
    return rows.unionByName(header)


@query(
    "",
    """SELECT c_custkey + 2 AS row_no, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
           c_mktsegment AS __col_3, CASE WHEN c_acctbal > 0 THEN 'paid' ELSE '' END AS name_2
    FROM customer""",
)
def grid_to_table(spark, sf):
    """Ragged grid to a table with a repaired header."""
    return read_grid(_grid(spark, sf))


@query("", "SELECT DISTINCT 'paid' AS id FROM customer WHERE c_acctbal > 0")
def grid_column_values(spark, sf):
    """Distinct values of one grid column below the header."""
    body = _grid(spark, sf).where("row_no > 1")
    return grid_ids(body, 3)


@query(
    "",
    """SELECT DISTINCT doc_id AS id, source AS processor_name, lang AS status_name FROM documents""",
)
def union_status_lists(spark, sf):
    """Lists fetched per status, united on the columns they have."""
    from innkeep.sources.documents import union_existing

    docs = V.table(spark, sf, "documents")
    lists = [
        docs.select(F.col("doc_id").alias("id"), F.col("source").alias("processor_name"), F.col("lang").alias("status_name"), "text"),
        docs.select(F.col("lang").alias("status_name"), F.col("doc_id").alias("id"), F.col("source").alias("processor_name")),
    ]
    return union_existing(lists, ["id", "processor_name", "status_name", "unit_name"])
