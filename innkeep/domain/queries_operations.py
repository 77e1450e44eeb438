"""Queries of the operational feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from innkeep.domain import views as V
from innkeep.domain.registry import query
from innkeep.functions import text as X
from innkeep.operators import numbering, rows as R
from innkeep.plans import operations as O
from innkeep.session import stored

# -- housekeeping --------------------------------------------------------------


def _housekeeping_docs(spark, sf) -> DataFrame:
    """One housekeeping response per reservation; in status 5 it has a second,
    earlier cleaning.  Flags are a list, one object or null; comments are text,
    blank, or an empty object."""
    one = F.format_string('{"name": "%s", "comments": "%s"}', "maketype_description", "type_name")
    flag = (
        F.when(F.col("type_name") == "1-URGENT", F.format_string('[%s, {"name": "VIP", "comments": {}}]', one))
        .when(F.col("type_name") == "2-HIGH", one)
        .when(F.col("type_name") == "3-MEDIUM", '{"name": "PET", "comments": " "}')
        .when(F.col("type_name") == "4-NOT SPECIFIED", "[]")
        .otherwise("null")
    )

    def record(kind: str, cleaning: str) -> Column:
        return F.format_string(
            '{"confirmation_id": "%s", "unit_id": "%s", "unit_name": "Unit %s", "cleaning_date": "%s", '
            f'"cleaning_type": "{kind}", "start_date": "%s", "end_date": "%s", "next_arrival_date": "%s", '
            '"flags": {"flag": %s}}',
            F.col("confirmation_id").cast("string"),
            F.when(F.col("status_id") == 8, "n/a").otherwise(F.col("unit_id").cast("string")),
            F.col("unit_id").cast("string"),
            F.date_format(cleaning, "MM/dd/yyyy"),
            F.date_format("startdate", "MM/dd/yyyy"),
            F.date_format("enddate", "MM/dd/yyyy"),
            F.date_format(F.date_add("enddate", 3), "MM/dd/yyyy"),
            flag,
        )

    last, early = record("full", "enddate"), record("short", "startdate")
    records = F.when(F.col("status_id") == 5, F.concat(early, F.lit(", "), last)).otherwise(last)
    body = F.format_string(
        '{"data": [{"result_id": "1", "past_count": "0", "reservations": {"reservation": [%s]}}]}', records
    )
    return stored(V.bookings(spark, sf).repartition("id").select(body.alias("body")), "housekeeping")


_FLAGS = """CASE type_name WHEN '1-URGENT' THEN maketype_description || ' (1-URGENT), VIP'
                WHEN '2-HIGH' THEN maketype_description || ' (2-HIGH)' WHEN '3-MEDIUM' THEN 'PET' END"""


_CLEANINGS = """cleanings AS (
    SELECT *, enddate AS cleaning, 'full' AS cleaning_type FROM reservations
    UNION ALL SELECT *, startdate, 'short' FROM reservations WHERE status_id = 5)"""


@query(
    "reservations",
    f"WITH {_CLEANINGS} SELECT CAST(id AS VARCHAR) AS confirmation_id, {_FLAGS} AS flags FROM cleanings",
)
def flag_text(spark, sf):
    """Flags of each cleaning, formatted and joined in order."""
    rows = O.housekeeping_rows(_housekeeping_docs(spark, sf))
    return rows.select("confirmation_id", O.flags_text("flag").alias("flags"))


@query(
    "",
    """SELECT l_orderkey, string_agg(flag, ', ' ORDER BY l_linenumber, l_shipdate, l_partkey, flag) AS flags
    FROM (SELECT *, CASE WHEN l_discount > 0.05 THEN l_returnflag || ' (' || l_linestatus || ')'
                         ELSE l_returnflag END AS flag FROM lineitem)
    GROUP BY l_orderkey""",
)
def flags_per_reservation(spark, sf):
    """Flags of all rows of a reservation joined in order, ties by the flag."""
    comment = F.when(F.col("l_discount") > 0.05, F.col("l_linestatus")).otherwise("")
    place = ["l_linenumber", "l_shipdate", "l_partkey"]
    rows = V.table(spark, sf, "lineitem").select(
        "l_orderkey", *place, X.flag_text("l_returnflag", comment).alias("flag")
    )
    return R.join_ordered(rows, ["l_orderkey"], "flag", [*place, "flag"], "flags")


_BOARD = f"""WITH {_CLEANINGS}, flagged AS (SELECT *, {_FLAGS} AS flags FROM cleanings)
    SELECT cleaning AS cleaning_date, cleaning_type, CAST(r.id AS VARCHAR) AS reservation,
           flags || CASE WHEN status_id = 5 THEN ', ' || flags ELSE '' END AS flags, type_name AS res_type,
           regexp_replace('Unit ' || unit_id || CASE WHEN status_id <> 8 THEN coalesce(' (' || bedrooms_number
               || 'br/' || bathrooms_number || 'ba)', '') ELSE '' END, '^Unit 7 .*$', 'House seven') AS unit,
           '' AS cleaning_event, '' AS unit_status, startdate AS check_in_date, enddate AS check_out_date,
           enddate + 3 AS next_arrival, '' AS next_arrival_type, '' AS next_arrival_flags, '' AS night_gap,
           CASE WHEN status_id <> 8 AND unit_id = 7 THEN 'Cleaning' ELSE 'Cleaning and laundry' END AS service_name,
           '' AS note, '' AS staff
    FROM flagged r LEFT JOIN units u ON r.unit_id = u.id"""


def _board(spark, sf) -> DataFrame:
    rows = O.with_flags(O.housekeeping_rows(_housekeeping_docs(spark, sf)))
    return O.housekeeping_board(
        rows,
        V.bookings(spark, sf).select("confirmation_id", "type_name"),
        V.units(spark, sf),
        "Cleaning and laundry",
        ["House seven"],
        "Cleaning",
        [("^Unit 7 .*$", "House seven")],
    )


@query("units reservations", _BOARD)
def housekeeping_board(spark, sf):
    """The cleaning board built from housekeeping responses."""
    return _board(spark, sf)


_MSG_DATES = """concat_ws('; ',
        CASE WHEN c.check_in_date IS DISTINCT FROM p.check_in_date
             THEN 'Check-In Date: de ' || p.check_in_date || ' para ' || c.check_in_date END,
        CASE WHEN c.check_out_date IS DISTINCT FROM p.check_out_date
             THEN 'Check-Out Date: de ' || p.check_out_date || ' para ' || c.check_out_date END,
        CASE WHEN c.next_arrival IS DISTINCT FROM p.next_arrival
             THEN 'Next Arrival: de ' || p.next_arrival || ' para ' || c.next_arrival END,
        CASE WHEN c.cleaning_date IS DISTINCT FROM p.cleaning_date
             THEN 'Cleaning Date: de ' || p.cleaning_date || ' para ' || c.cleaning_date END,
        CASE WHEN c.unit IS DISTINCT FROM p.unit
             THEN 'Unit: de ''' || p.unit || ''' para ''' || c.unit || '''' END)"""


@query(
    "board_previous board_current",
    f"""SELECT p.reservation, 'changed' AS change,
           c.check_in_date AS check_in_date_current, p.check_in_date AS check_in_date_previous,
           c.check_out_date AS check_out_date_current, p.check_out_date AS check_out_date_previous,
           c.next_arrival AS next_arrival_current, p.next_arrival AS next_arrival_previous,
           c.cleaning_date AS cleaning_date_current, p.cleaning_date AS cleaning_date_previous,
           c.unit AS unit_current, p.unit AS unit_previous,
           'Reserva #' || p.reservation || ' foi alterada.' || chr(10) || '  Alterações: ' || {_MSG_DATES} AS message
    FROM board_current c JOIN board_previous p ON c.reservation = p.reservation
    WHERE (c.next_arrival IS DISTINCT FROM p.next_arrival OR c.cleaning_date IS DISTINCT FROM p.cleaning_date
           OR c.unit IS DISTINCT FROM p.unit) AND c.cleaning_date >= DATE '1998-06-15'
    UNION ALL
    SELECT p.reservation, 'cancelled', NULL, p.check_in_date, NULL, p.check_out_date, NULL, p.next_arrival,
           NULL, p.cleaning_date, NULL, p.unit,
           'Reserva #' || p.reservation || ' foi cancelada e excluída, pois não consta no arquivo atual. '
           || '(Cleaning Date: ' || p.cleaning_date || ', Unit: ''' || p.unit || ''')'
    FROM board_previous p
    WHERE p.reservation NOT IN (SELECT reservation FROM board_current) AND p.cleaning_date > DATE '1998-06-15'""",
)
def snapshot_changes(spark, sf):
    """Changed and cancelled cleanings between two boards, with messages."""
    return O.housekeeping_changes(V.board_current(spark, sf), V.board_previous(spark, sf), V.AS_OF)


@query(
    "board_previous",
    """SELECT reservation || CASE WHEN reservation IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
                                  WHERE o_orderpriority = '1-URGENT') THEN '.0' ELSE '' END AS reservation,
           unit, check_in_date, check_out_date, next_arrival, cleaning_date
    FROM board_previous""",
)
def board_sheet(spark, sf):
    """Yesterday's board written to its sheet as text and read back as a grid."""
    sheet = O.board_to_sheet(V.board_previous(spark, sf))
    cells = F.array(*[F.col(f"`{c}`") for c in sheet.columns])
    header = spark.range(1).select(
        F.lit(0).cast("bigint").alias("row_no"), F.array(*[F.lit(c) for c in sheet.columns]).alias("cells")
    )
    body = numbering.number_rows(sheet, ["Reservation #"]).select("row_no", cells.alias("cells"))
    return O.board_from_sheet(header.unionByName(body))


# -- arrivals --------------------------------------------------------------------

_FRIDAY = dt.date(1998, 6, 19)


def _info_docs(spark, sf) -> DataFrame:
    """One reservation response per reservation, its lock code in a name/value
    list; the last duplicate counts."""
    code = (
        F.when(F.col("type_name") == "1-URGENT", F.col("id").cast("string"))
        .when(F.col("type_name") == "2-HIGH", "0")
        .when(F.col("type_name") == "3-MEDIUM", "abc")
        .otherwise("")
    )
    pair = lambda value: F.struct(F.lit("Lock Code").alias("name"), value.alias("value"))
    fields = F.when(
        F.col("type_name") != "5-LOW", F.struct(F.array(pair(F.lit("99")), pair(code)).alias("additional_field"))
    )
    info = F.struct(
        F.col("confirmation_id").cast("string").alias("confirmation_id"),
        F.date_format("startdate", "MM/dd/yyyy").alias("startdate"),
        F.concat(F.lit("Unit "), F.col("unit_id").cast("string")).alias("unit_name"),
        F.lit("555").alias("phone"),
        F.when(F.col("status_id") == 4, F.col("first_name")).alias("first_name"),
        F.col("last_name"),
        fields.alias("additional_fields"),
    )
    docs = V.bookings(spark, sf).repartition("id").select(
        "confirmation_id",
        F.to_json(F.struct(F.struct(info.alias("reservation")).alias("data"))).alias("body"),
    )
    return stored(docs, "infos")


_ARRIVALS = """SELECT startdate, 'Unit ' || unit_id AS unit_name,
           CASE WHEN status_id = 4 THEN 'Guest ' ELSE '' END || last_name AS client_name, '555' AS phone,
           confirmation_id || CASE WHEN type_name = '1-URGENT' THEN '#' ELSE '' END AS door_code,
           CASE WHEN type_name = '1-URGENT' THEN 'with code' ELSE 'without code' END AS emergency_code
    FROM reservations
    WHERE startdate {days} AND status_id NOT IN (6, 8, 10, 1) AND status_code NOT IN (6, 8, 10, 1)
      AND confirmation_id > 0"""


def _arrivals(spark, sf, as_of):
    sheet = O.arrivals_sheet(
        V.bookings(spark, sf), _info_docs(spark, sf), as_of, "Lock Code", "with code", "without code"
    )
    return O.by_arrival(sheet)


@query("reservations", _ARRIVALS.format(days="= DATE '1998-06-15'"))
def arrivals_sheet(spark, sf):
    """Arrivals of a weekday."""
    return _arrivals(spark, sf, V.AS_OF)


@query("reservations", _ARRIVALS.format(days="BETWEEN DATE '1998-06-19' AND DATE '1998-06-21'"))
def arrivals_sheet_friday(spark, sf):
    """Arrivals reported on a Friday: the weekend too."""
    return _arrivals(spark, sf, _FRIDAY)


@query(
    "reservations",
    """SELECT id AS confirmation_id, 'Unit ' || unit_id AS unit_name,
           confirmation_id || CASE WHEN type_name = '1-URGENT' THEN '#' ELSE '' END AS door_code
    FROM reservations""",
)
def door_codes(spark, sf):
    """Door codes of all reservation responses."""
    from innkeep.functions.numbers import code_or
    from innkeep.operators.nested import named_value, split_documents
    from innkeep.schemas import RESERVATION_INFO_DOC

    good, _ = split_documents(_info_docs(spark, sf), "body", RESERVATION_INFO_DOC, "$.data.reservation")
    info = good.select("confirmation_id", F.col("doc.data.reservation").alias("r"))
    code: Column = named_value("r.additional_fields.additional_field", "Lock Code")
    return info.select(
        "confirmation_id", F.col("r.unit_name").alias("unit_name"), code_or(code, "r.confirmation_id").alias("door_code")
    )


# -- work orders -------------------------------------------------------------------

_PHRASES = ["All rights reserved", "c++ (draft)", "WORTHLESS"]
_CATEGORIES = {"src0": "POOL", "src1": "GUEST", "src2": "CLEANING", "src13": "OWNER"}
_FALLBACKS = [(["es"], "GUEST"), (["de", "fr"], "MAINTENANCE")]

_TRIAGE = r"""triaged AS (
    SELECT unit_name, title, id, opened, processor_name, status_name,
           lower(nullif(regexp_extract(title, '\(([^)]+)\)[\s]*$', 1), '')) AS tag
    FROM (SELECT * REPLACE (trim(regexp_replace(title, '[\s\x{0b}\x{85}\p{Z}]+', ' ', 'g')) AS title)
          FROM work_orders)
    WHERE NOT regexp_matches(title, '(?i)All rights reserved|c\+\+ \(draft\)|WORTHLESS')
      AND id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))"""
_AREA = """coalesce(CASE tag WHEN 'src0' THEN 'POOL' WHEN 'src1' THEN 'GUEST' WHEN 'src2' THEN 'CLEANING'
                  WHEN 'src13' THEN 'OWNER' END,
                CASE WHEN processor_name = 'es' THEN 'GUEST' WHEN processor_name IN ('de', 'fr')
                     THEN 'MAINTENANCE' END, '')"""


def _triage(spark, sf) -> DataFrame:
    known = V.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return O.work_order_triage(V.work_orders(spark, sf), known, _PHRASES, _CATEGORIES, _FALLBACKS)


@query(
    "work_orders",
    f"""WITH {_TRIAGE}
    SELECT unit_name, title, {_AREA} AS area, strftime(opened, '%Y-%m-%d 08:00:00') AS created, id,
           processor_name, status_name
    FROM triaged""",
)
def work_order_triage(spark, sf):
    """New work orders with cleaned titles and their area."""
    return _triage(spark, sf)


@query(
    "work_orders",
    f"""WITH {_TRIAGE}
    SELECT id, created, area, (SELECT count(*) FROM labels) + row_number() OVER (ORDER BY created, id) AS row_no
    FROM (SELECT id, strftime(opened, '%Y-%m-%d 08:00:00') AS created, {_AREA} AS area FROM triaged)""",
)
def append_numbering(spark, sf):
    """New rows numbered after the last filled row of the tracking sheet."""
    labels = V.table(spark, sf, "labels").select("doc_id")
    sheet = numbering.number_rows(labels, ["doc_id"]).select("row_no", F.lit("House").alias("unit_name"))
    trailing = sheet.withColumns({"row_no": F.col("row_no") + 1_000_000, "unit_name": F.lit(" ")})
    target = sheet.unionByName(trailing)
    new = _triage(spark, sf).select("id", "created", "area")
    return numbering.number_after(new, target, "row_no", "unit_name", ["created", "id"])
