"""Reservation marts: clean load, quality gate, nightly prices, by-date rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from innkeep import schemas
from innkeep.functions import dates as D
from innkeep.functions.numbers import MONEY, to_number
from innkeep.operators import cleaning, joins, nested, quality, rows
from innkeep.operators.columns import clean_columns, conform, drop_clashing
from innkeep.sources import open_records
from innkeep.sources.documents import page_reservations

# Money columns of a reservation, and the status codes that count
# as reservations of the by-date mart; where a response holds its records.
PRICE_COLUMNS = ("price_nightly", "price_total", "price_paidsum", "price_common", "price_balance")
BY_DATE_STATUS = (4, 5, 6, 7)
RESERVATION_PATHS = ("$.data.reservations", "$.reservations")
WHOLE_COLUMNS = (
    "id", "confirmation_id", "unit_id", "client_id", "occupants", "occupants_small", "days_number",
    "status_code", "status_id",
)


def reservations_clean(pages: DataFrame, manager: str, body: str = "body", page: str = "page") -> DataFrame:
    """Typed reservations from landed pages: the first occurrence of an id in
    page order, null tokens removed, whole numbers, money and dates parsed, timestamps
    in the business zone.  What does not parse is NULL."""
    records = page_reservations(pages, body, page)
    unique = rows.first_by(records, ["id"], ["page", "pos"]).drop("page", "pos")
    named = clean_columns(unique.withColumn("manager", F.lit(manager)))
    return _typed(cleaning.null_tokens(named))


def _typed(clean: DataFrame) -> DataFrame:
    """The declared columns typed; what does not parse is NULL."""
    return clean.withColumns(
        {
            **{c: to_number(c, "bigint") for c in WHOLE_COLUMNS},
            **{c: to_number(c, MONEY) for c in PRICE_COLUMNS},
            **{c: D.to_business_time(D.parse_ts(c)) for c in ("creation_date", "last_updated")},
            **{c: D.parse_date(c) for c in ("startdate", "enddate")},
        }
    )


def reservations_landed(
    pages: DataFrame,
    manager: str,
    page_size: int | None = None,
    run: str | None = None,
    body: str = "body",
    page: str = "page",
) -> DataFrame:
    """As ``reservations_clean``, with every field that any response holds.

    Declared columns come first, typed as there; the others follow, typed by their
    values, objects flattened and lists as JSON text.  With ``page_size`` a run of pages
    ends at its first short or empty page.  Of repeated ids the first in page order
    stays (``run`` before ``page``).  Ids that are missing count as one, as in a
    table keyed by them."""
    order = [run, page] if run else [page]
    landed = open_records.land_pages(pages, body, RESERVATION_PATHS, order)
    if page_size is not None:
        landed = open_records.until_short_page(landed, page, page_size, run)
    records = open_records.page_records(landed, order)
    declared = [c.split()[0] for c in schemas.RESERVATION.split(", ")]
    place = [f"_{c}" for c in (*order, "pos")]
    typed = open_records.typed_records(
        records.withColumnsRenamed(dict(zip((*order, "pos"), place))), place, declared
    )
    unique = rows.first_by(typed, ["id"], place).drop(*place)
    named = clean_columns(unique.withColumn("manager", F.lit(manager)))
    return _typed(cleaning.null_tokens(named))


def reservation_quality_gate(new: DataFrame, base: DataFrame, **limits) -> DataFrame:
    """Checks of a reservation load against the published one."""
    return quality.quality_gate(new, base, "price_nightly", **limits)


def reservation_price_days(
    docs: DataFrame, load_time: Column, manager: Column, body: str = "body"
) -> DataFrame:
    """Nightly prices, typed and in stored column order."""
    days = nested.explode_price_days(docs, body, load_time, manager)
    numbers = ("price", "extra", "discount", "original_cost")
    typed = days.withColumns(
        {
            "date": D.parse_date_day_first("date"),
            "reservation_id": to_number("reservation_id", "bigint"),
            **{c: to_number(c) for c in numbers},
        }
    )
    return conform(typed, schemas.PRICE_DAYS)


def reservations_by_date(
    reservations: DataFrame,
    price_days: DataFrame,
    mirrors: DataFrame,
    booking_patches: DataFrame | None = None,
    statuses: Sequence[int] = BY_DATE_STATUS,
    latest_only: bool = True,
    load_time: str = "data_price",
) -> DataFrame:
    """Reservations with one row per priced night.

    Only each reservation's latest price load is joined (``latest_only=False``
    joins them all).  Mirror units are mapped to their main unit after the
    join; listed bookings get a corrected booking date.  Of columns both sides
    have, the reservation's stays."""
    kept = reservations.where(F.col("status_id").try_cast("bigint").isin(*statuses))
    kept = cleaning.remap(kept, "unit_id", mirrors)
    if booking_patches is not None:
        kept = cleaning.patch(kept, "id", "creation_date", booking_patches)
    extra = drop_clashing(price_days, kept).columns
    return joins.left_details(
        kept,
        price_days,
        {"id": "reservation_id"},
        {c: c for c in extra},
        latest=load_time if latest_only else None,
    )
