"""Operational feeds: housekeeping board and changes, arrivals, work orders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from innkeep import schemas
from innkeep.functions import dates as D, text as X
from innkeep.functions.numbers import code_or, has_code, to_number
from innkeep.operators import nested
from innkeep.operators.changes import change_text, snapshot_changes
from innkeep.operators.cleaning import set_where_in
from innkeep.operators.columns import conform, map_columns
from innkeep.operators.joins import lookup
from innkeep.operators.rows import in_both, join_ordered, not_in, pending
from innkeep.sinks.export import as_text
from innkeep.sources.sheets import read_grid

# Board columns and where they come from (None stays empty).
BOARD = {
    "cleaning_date": "cleaning_date",
    "cleaning_type": "cleaning_type",
    "reservation": "confirmation_id",
    "flags": "flag_text",
    "res_type": "type_name",
    "unit": "unit",
    "cleaning_event": None,
    "unit_status": None,
    "check_in_date": "start_date",
    "check_out_date": "end_date",
    "next_arrival": "next_arrival_date",
    "next_arrival_type": None,
    "next_arrival_flags": None,
    "night_gap": None,
    "service_name": "service_name",
    "note": None,
    "staff": None,
}

# Titles of the board's columns on its sheet.
BOARD_TITLES = {
    "cleaning_date": "Cleaning Date",
    "cleaning_type": "Cleaning Type",
    "reservation": "Reservation #",
    "flags": "Flags",
    "res_type": "Res Type",
    "unit": "Unit",
    "cleaning_event": "Cleaning Event",
    "unit_status": "Unit Status",
    "check_in_date": "Check-In Date",
    "check_out_date": "Check-Out Date",
    "next_arrival": "Next Arrival",
    "next_arrival_type": "Next Arrival Type",
    "next_arrival_flags": "Next Arrival Flags",
    "night_gap": "Night Gap",
    "service_name": "Service name",
    "note": "Observacao",
    "staff": "Staff",
}

# Statuses that do not arrive.
NO_ARRIVAL = (6, 8, 10, 1)

_FLAG = "struct<name: string, comments: variant>"
_PLACE = ("page", "group_no", "pos")


def housekeeping_rows(docs: DataFrame, body: str = "body", page: Column | None = None) -> DataFrame:
    """Report rows of landed housekeeping responses, one per scheduled cleaning,
    each with its place (page, group_no, pos)."""
    doc = F.from_json(body, schemas.HOUSEKEEPING_DOC).getField("data")
    page = F.lit(0).cast("bigint") if page is None else page
    groups = docs.select(page.alias("page"), F.posexplode(doc).alias("group_no", "g"))
    rows = groups.select(
        "page",
        "group_no",
        "g.result_id",
        "g.past_count",
        F.posexplode("g.reservations.reservation").alias("pos", "r"),
    )
    flat = rows.select("r.*", "result_id", "past_count", "page", "group_no", "pos")
    return flat.withColumn("flag", F.col("flags.flag")).drop("flags")


def with_flags(rows: DataFrame) -> DataFrame:
    """Report rows with ``flag_text``: the flags of all rows of their reservation,
    in report order.  Each row's own flags are joined before rows meet."""
    own = rows.select("confirmation_id", *_PLACE, flags_text("flag").alias("flag_text")).where(
        "flag_text is not null and confirmation_id is not null"
    )
    joined = join_ordered(own, ["confirmation_id"], "flag_text", _PLACE, "flag_text")
    return lookup(
        rows.drop("flag", *_PLACE), joined, {"confirmation_id": "confirmation_id"}, {"flag_text": "flag_text"}
    )


def flags_text(flag: Column | str) -> Column:
    """All flags of a row, formatted and joined in order; NULL without flags.
    A comment that is not plain text counts as blank."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    flags = F.filter(nested.as_list(flag, _FLAG), lambda f: f.isNotNull())

    def one(f: Column) -> Column:
        kind = F.schema_of_variant(f.getField("comments"))
        plain = F.when(
            ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"),
            F.try_variant_get(f.getField("comments"), "$", "string"),
        )
        return X.flag_text(f.getField("name"), plain)

    return F.when(F.size(flags) > 0, F.array_join(F.transform(flags, one), ", "))


def housekeeping_board(
    rows: DataFrame,
    reservations: DataFrame,
    sizes: DataFrame,
    service: str,
    special_units: Sequence[str] = (),
    special_service: str = "",
    label_rules: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """The cleaning board: reservation type, unit with its size label, service.

    ``rows`` hold confirmation_id, unit_id, unit_name, dates and flag_text;
    ``sizes`` hold id, bedrooms_number, bathrooms_number."""
    typed = rows.withColumns(
        {
            "_confirmation": to_number("confirmation_id", "bigint"),
            "_unit": to_number("unit_id", "bigint"),
        }
    )
    typed = lookup(
        typed, reservations, {"_confirmation": "confirmation_id"}, {"type_name": "type_name"}
    )
    labels = sizes.select(
        to_number("id", "bigint").alias("id"),
        X.size_label("bedrooms_number", "bathrooms_number").alias("size"),
    ).distinct()
    sized = lookup(typed, labels, {"_unit": "id"}, {"size": "size"})
    labelled = sized.withColumns(
        {
            "unit": X.fix_labels(X.unit_label("unit_name", "size"), label_rules),
            "service_name": F.lit(service),
        }
    )
    board = map_columns(labelled, BOARD)
    dated = board.withColumns({c: D.as_date(board, c) for c in schemas.BOARD_DATES})
    return set_where_in(dated, "unit", special_units, "service_name", special_service)


def board_to_sheet(board: DataFrame) -> DataFrame:
    """The board as text under its sheet titles."""
    text = as_text(board, schemas.BOARD_DATES)
    return text.withColumnsRenamed({n: t for n, t in BOARD_TITLES.items() if n in text.columns})


def board_from_sheet(grid: DataFrame) -> DataFrame | None:
    """A stored board back from its sheet (row_no, cells): titled columns only,
    dates read day-first, blank texts as they are.  None for an empty sheet."""
    table = read_grid(grid)
    if table is None:
        return None
    names = {title: name for name, title in BOARD_TITLES.items()}
    board = table.select(*[F.col(f"`{c}`").alias(names[c]) for c in table.columns if c in names])
    dates = [c for c in schemas.BOARD_DATES if c in board.columns]
    return board.withColumns({c: D.parse_date_day_first(c) for c in dates})


def housekeeping_changes(current: DataFrame, previous: DataFrame, as_of: dt.date) -> DataFrame:
    """Changed and cancelled cleanings between two boards, with a message each.
    A missing unit compares as a blank one."""
    fields = ["check_in_date", "check_out_date", "next_arrival", "cleaning_date", "unit"]
    diff = snapshot_changes(
        current.fillna("", ["unit"]),
        previous.fillna("", ["unit"]),
        "reservation",
        fields,
        ["next_arrival", "cleaning_date", "unit"],
        "cleaning_date",
        as_of,
    )
    titles = {
        "check_in_date": "Check-In Date",
        "check_out_date": "Check-Out Date",
        "next_arrival": "Next Arrival",
        "cleaning_date": "Cleaning Date",
    }
    return diff.withColumn("message", change_text("reservation", titles, "unit", "cleaning_date"))


def units_to_register(missing_a: DataFrame, missing_b: DataFrame) -> DataFrame:
    """Units reported missing by both uploads."""
    return in_both(missing_a.select("unit"), missing_b.select("unit"))


def arriving(reservations: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct confirmations arriving on the reported days.  A missing status
    does not arrive."""
    days = [F.lit(d) for d in D.arrival_days(as_of)]
    return (
        reservations.where(
            F.col("startdate").cast("date").isin(*days)
            & not_in("status_code", NO_ARRIVAL)
            & not_in("status_id", NO_ARRIVAL)
            & (F.col("confirmation_id") > 0)
        )
        .select("confirmation_id")
        .distinct()
    )


def arrivals_sheet(
    reservations: DataFrame,
    docs: DataFrame,
    as_of: dt.date,
    code_field: str,
    emergency_with_code: str,
    emergency_without: str,
    body: str = "body",
) -> DataFrame:
    """Arrivals sheet from reservation responses (confirmation_id, body): guest
    name, door code and emergency code.  Sort when writing: ``by_arrival``."""
    due = docs.join(arriving(reservations, as_of), "confirmation_id", "left_semi")
    good, _ = nested.split_documents(
        due, body, schemas.RESERVATION_INFO_DOC, "$.data.reservation", "object"
    )
    info = good.select(
        F.col("confirmation_id").alias("_confirmation"),
        F.col("doc.data.reservation").alias("r"),
    )
    code = nested.named_value("r.additional_fields.additional_field", code_field)
    rows = info.select(
        D.parse_date("r.startdate").alias("startdate"),
        F.col("r.unit_name").alias("unit_name"),
        X.full_name("r.first_name", "r.last_name").alias("client_name"),
        F.col("r.phone").alias("phone"),
        code_or(code, F.coalesce("r.confirmation_id", F.col("_confirmation").cast("string"))).alias("door_code"),
        F.when(has_code(code), emergency_with_code).otherwise(emergency_without).alias("emergency_code"),
    )
    return conform(rows, schemas.ARRIVALS_SHEET)


def by_arrival(sheet: DataFrame) -> DataFrame:
    """Sheet order."""
    return sheet.orderBy("startdate", "unit_name", "client_name")


def work_order_rows(docs: DataFrame, body: str = "body") -> DataFrame:
    """Work orders of landed responses, one response per status, without repeats."""
    doc = F.from_json(body, schemas.WORK_ORDERS_DOC).getField("data")
    orders = doc.getField("maintenances").getField("maintenance")
    return docs.select(F.inline(orders)).distinct()


def work_order_triage(
    orders: DataFrame,
    known_ids: DataFrame,
    phrases: Sequence[str],
    categories: Mapping[str, str],
    fallbacks: Sequence[tuple[Sequence[str], str]] = (),
) -> DataFrame:
    """New work orders for the tracking sheet: titles cleaned, routine titles and
    blank units left out, the area taken from the title's tag or the processor."""
    clean = (
        orders.distinct()
        .withColumn("title", X.squeeze("title"))
        .where(X.excludes_phrases("title", phrases) & X.non_blank("unit_name"))
    )
    typed = clean.withColumns(
        {"id": X.id_text("id"), "created": D.parse_local_ts("creation_date")}
    )
    fresh = pending(typed, known_ids.select(F.col("id").cast("string").alias("id")), ["id"])
    tag = X.trailing_tag("title")
    return fresh.select(
        "unit_name",
        "title",
        X.area(tag, "processor_name", categories, fallbacks).alias("area"),
        F.coalesce(F.date_format("created", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("created"),
        "id",
        F.coalesce("processor_name", F.lit("")).alias("processor_name"),
        F.coalesce("status_name", F.lit("")).alias("status_name"),
    )
