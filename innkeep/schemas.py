"""Declared schemas of landed documents and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# -- landed documents (all scalars arrive as text) ---------------------------

RESERVATION = (
    "id string, confirmation_id string, unit_id string, client_id string, "
    "occupants string, occupants_small string, days_number string, status_code string, "
    "status_id string, type_name string, maketype_description string, "
    "hear_about_name string, travelagent_name string, location_name string, "
    "email string, first_name string, last_name string, price_nightly string, "
    "price_total string, price_paidsum string, price_common string, price_balance string, "
    "creation_date string, last_updated string, startdate string, enddate string"
)
RESERVATION_PAGE = (
    f"data struct<reservations: array<struct<{RESERVATION.replace(' string', ': string')}>>>, "
    f"reservations array<struct<{RESERVATION.replace(' string', ': string')}>>"
)
PRICE_DAY = "date: string, season: string, price: string, extra: string, discount: string, original_cost: string"
PRICE_DAYS_DOC = (
    f"data struct<reservation_id: string, reservation_days: array<struct<{PRICE_DAY}>>>"
)
FEES_DOC = (
    "data struct<commission_information: variant, taxes_and_fees: struct<tax_fee: variant>>"
)
FEE = (
    "struct<id: string, name: string, value: string, percent: string, include_as_tax: string, "
    "taxable: string>"
)
BLOCKED_PERIOD = "array<struct<startdate: string, enddate: string>>"
RATES_DOC = (
    "data array<struct<date: string, season: string, rate: string, minStay: string, "
    "rate_type: struct<season: string, rate: string, minStay: string>>>"
)
CUSTOM_FIELDS_DOC = (
    "data struct<field: array<struct<field_id: bigint, name: string, value: string>>>"
)
RESERVATION_INFO_DOC = (
    "data struct<reservation: struct<id: string, confirmation_id: string, "
    "referrer_url: string, startdate: string, unit_name: string, phone: string, "
    "first_name: string, last_name: string, additional_fields: struct<"
    "additional_field: array<struct<name: string, value: string>>>>>"
)
HOUSEKEEPING_DOC = (
    "data array<struct<result_id: string, past_count: string, reservations: struct<"
    "reservation: array<struct<confirmation_id: string, unit_id: string, unit_name: string, "
    "cleaning_date: string, cleaning_type: string, start_date: string, end_date: string, "
    "next_arrival_date: string, flags: struct<flag: variant>>>>>>"
)
WORK_ORDERS_DOC = (
    "data struct<maintenances: struct<maintenance: array<struct<unit_id: string, "
    "unit_name: string, title: string, creation_date: string, id: string, "
    "processor_name: string, status_name: string>>>>"
)
PROPERTY_FIELDS = (
    "id: string, name: string, location_name: string, bedrooms_number: string, "
    "bathrooms_number: string, condo_type_name: string, condo_type_group_name: string, "
    "max_adults: string, renting_type: string"
)
PROPERTIES_DOC = f"data struct<property: array<struct<{PROPERTY_FIELDS}>>>"

# -- stored tables -----------------------------------------------------------

_DAY, _TEXT, _LONG, _INT = T.DateType(), T.StringType(), T.LongType(), T.IntegerType()
_REAL, _TIME = T.DoubleType(), T.TimestampNTZType()
_MONEY, _PERCENT = T.DecimalType(18, 2), T.DecimalType(10, 4)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRICE_DAYS = _table(
    date=_DAY,
    season=_TEXT,
    price=_REAL,
    extra=_REAL,
    discount=_REAL,
    original_cost=_REAL,
    reservation_id=_LONG,
    data_price=_TIME,
    manager=_TEXT,
)
TAXES_AND_FEES = _table(
    confirmation_id=_INT,
    row_type=_TEXT,
    fee_id=_LONG,
    name=_TEXT,
    value=_MONEY,
    percent=_PERCENT,
    include_as_tax=_INT,
    taxable=_INT,
    management_commission_amount=_MONEY,
    management_commission_percent=_PERCENT,
    owner_commission_amount=_MONEY,
    owner_commission_percent=_PERCENT,
)
REFERRERS = _table(
    id=_LONG, confirmation_id=_LONG, referrer_url=_TEXT, collected_at=_TIME, manager=_TEXT
)
MONTHLY_OCCUPANCY = _table(
    unit_id=_LONG,
    year=_INT,
    month=_INT,
    month_str=_TEXT,
    occupancy_rate=_REAL,
    days_occupied=_INT,
    days_in_month=_INT,
    days_elapsed=_INT,
    days_occupied_past=_INT,
    days_occupied_future=_INT,
    is_complete_month=_INT,
    is_future_month=_INT,
)
DAILY_OCCUPANCY = _table(
    unit_id=_LONG,
    confirmation_id=_TEXT,
    occupied_date=_DAY,
    days=_INT,
    year=_INT,
    month=_INT,
    day=_INT,
    month_str=_TEXT,
    startdate=_DAY,
    enddate=_DAY,
    rate=T.DecimalType(12, 2),
)
CHECK_LOG = _table(table_name=_TEXT, source_job=_TEXT, run_at=_TIME, status=_INT)
ARRIVALS_SHEET = _table(
    startdate=_DAY,
    unit_name=_TEXT,
    client_name=_TEXT,
    phone=_TEXT,
    door_code=_TEXT,
    emergency_code=_TEXT,
)
BOARD_DATES = ("cleaning_date", "check_in_date", "check_out_date", "next_arrival")
