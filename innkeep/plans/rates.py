"""Rate, fee and referrer marts from landed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from innkeep import schemas
from innkeep.functions.numbers import to_number
from innkeep.operators import nested
from innkeep.operators.columns import clean_columns, conform
from innkeep.operators.rows import not_in, pending, union_ragged
from innkeep.operators.cleaning import cast_if_all_parse, nested_to_json
from innkeep.plans.dimensions import RENTING
from innkeep.session import stored
from innkeep.sinks.tables import write_history_and_current
from innkeep.sources import open_records


def taxes_and_fees(docs: DataFrame, body: str = "body") -> DataFrame:
    """Fee and commission rows, typed."""
    return conform(nested.type_fees(nested.explode_fees(docs, body)), schemas.TAXES_AND_FEES)


def rate_rows(docs: DataFrame, load_time: Column, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(rates, rejects) of rate responses (unit_id, manager, body): one row per
    day, nested fields flattened to dotted names, with unit, load time, manager."""
    good, rejects = nested.split_documents(docs, body, schemas.RATES_DOC, "$.data", "list")
    rows = good.select("unit_id", "manager", F.explode("doc.data").alias("r"))
    flat = nested.flatten(rows.select("unit_id", "manager", "r.*"))
    return (
        flat.withColumnRenamed("unit_id", "id_unit").withColumn("data_price", load_time),
        rejects,
    )


def price_rows(
    docs: DataFrame, load_time: Column, skip_units: tuple[int, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(prices, rejects) of the requested units; listed units are not priced."""
    return rate_rows(docs.where(not_in("unit_id", skip_units)), load_time)


def load_prices(
    docs: DataFrame, load_time: Column, load: str, history: str, current: str, skip_units: tuple[int, ...] = ()
) -> DataFrame:
    """Take one load of price responses into the history and make it the current table;
    returns the rejected responses.  A load without any price changes neither."""
    prices, rejects = price_rows(docs, load_time, skip_units)
    flat = stored(clean_columns(prices), "prices")
    if not flat.isEmpty():
        write_history_and_current(flat, history, current, load)
    return rejects


def pending_targets(properties: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rented-out units whose target rates are not loaded yet."""
    active = properties.where(F.col("renting_type") == RENTING).select("id", "manager")
    return pending(active, loaded.select(F.col("id_unit").alias("id")), ["id"])


def target_rates(
    sheet: DataFrame, docs: DataFrame, properties: DataFrame, load_time: Column
) -> DataFrame:
    """Target rates: the sheet's rows plus the responses of every unit the sheet
    does not cover.  All pending units are loaded in one pass."""
    todo = pending_targets(properties, sheet).select(F.col("id").alias("unit_id")).distinct()
    fresh = docs.join(todo, "unit_id", "left_semi")
    rows, _ = rate_rows(fresh, load_time)
    return union_ragged([sheet, rows])


def unit_filter_flag(
    docs: DataFrame, field_id: int, load_time: Column, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of custom-field responses (unit_id, manager, body),
    keeping one field id."""
    good, rejects = nested.split_documents(docs, body, schemas.CUSTOM_FIELDS_DOC, "$.data.field", "list")
    keep = good.select(F.col("unit_id").alias("id_unit"), "manager", F.col("doc.data.field").alias("_fields"))
    rows = nested.field_rows(keep, "_fields", field_id, ["id_unit", "manager"])
    return rows.withColumn("data_price", load_time), rejects


def referrers(docs: DataFrame, collected_at: Column, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of reservation responses (manager, body): id,
    confirmation and referring URL."""
    good, rejects = nested.split_documents(
        docs, body, schemas.RESERVATION_INFO_DOC, "$.data.reservation", "object"
    )
    rows = nested.pick(good, "doc.data.reservation", ["id", "confirmation_id", "referrer_url"])
    typed = rows.withColumns(
        {
            "id": to_number("id", "bigint"),
            "confirmation_id": to_number("confirmation_id", "bigint"),
            "collected_at": collected_at,
        }
    )
    return conform(typed, schemas.REFERRERS), rejects


def active_houses(properties: DataFrame, maybe_dates: tuple[str, ...] = ()) -> DataFrame:
    """Property list flattened to dotted names; text columns that are entirely
    dates become dates, nested leftovers JSON text."""
    flat = nested.flatten(properties)
    return nested_to_json(cast_if_all_parse(flat, [c for c in maybe_dates if c in flat.columns]))


def active_houses_landed(
    docs: DataFrame, load_time: Column, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """(houses, rejects) of property-list responses: every field any response holds,
    objects flattened to dotted names, text columns that are entirely dates as dates,
    lists as JSON text."""
    reason = nested.reject_reason(body, "$.data.property", "list")
    judged = docs.withColumn("reason", reason)
    landed = open_records.land_pages(judged, body, ["$.data.property"], [c for c in judged.columns if c != body])
    records = open_records.page_records(landed, [])
    houses = open_records.typed_records(records)
    texts = [f.name for f in houses.schema.fields if isinstance(f.dataType, T.StringType)]
    dated = cast_if_all_parse(houses, texts)
    rejects = landed.where("reason is not null").drop("n", "records")
    return dated.withColumn("data_load", load_time), rejects
