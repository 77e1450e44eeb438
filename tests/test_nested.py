import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from innkeep import schemas
from innkeep.operators import nested as N
from innkeep.plans import occupancy, operations, rates, reservations as RP
from innkeep.sources import documents

LOAD = "2025-01-02 03:04:05"


def load_time():
    return F.lit(LOAD).cast("timestamp_ntz")



def docs(spark, *bodies, **columns):
    extra = "".join(f", {name} string" for name in columns)
    return spark.createDataFrame(
        [(i, b if isinstance(b, (str, type(None))) else json.dumps(b), *columns.values()) for i, b in enumerate(bodies)],
        "unit_id int, body string" + extra,
    )


def test_envelopes(spark, rows):
    period = [{"startdate": "01/02/2025", "enddate": "01/05/2025"}]
    df = docs(
        spark,
        period,
        {"Response": {"data": {"blocked_period": period}}},
        {"Response": {"data": period}},
        {"data": period},
        {"data": {"blocked_period": period}},
        {"status": {"code": "E1"}},
        {"data": {"blocked_period": []}},
        {"data": {"blocked_period": [{"startdate": "02/30/2025", "enddate": "x"}]}},
        "not json",
        None,
    )
    day = (dt.date(2025, 1, 2), dt.date(2025, 1, 5))
    assert rows(occupancy.blocked_periods(df)) == [(i, *day) for i in range(5)]


def test_reject_reasons(spark, rows):
    df = docs(
        spark,
        {"data": {"a": 1}},
        {"data": [1]},
        {"status": {"code": "SUCCESS"}, "data": {"a": 1}},
        {"status": {"code": 0}, "data": {"a": 1}},
        {"status": {"code": "E0013"}, "data": {"a": 1}},
        {"data": {}},
        {"data": None},
        {"data": "text"},
        [],
        "<html>",
        "  ",
        None,
    )
    reasons = df.select(N.reject_reason("body", "$.data").alias("r")).collect()
    assert [r.r for r in reasons] == [
        None, None, None, None, "status E0013", "empty data", "empty data", "empty data",
        "empty data", "invalid json", "empty body", "empty body",
    ]
    good, rejects = N.split_documents(df, "body", "data struct<a: int>", "$.data")
    assert good.count() == 4 and rejects.count() == 8
    assert rows(N.reject_counts(rejects))[0] == ("empty body", 2)
    assert ("ok", 4) in rows(N.tally(df, "body", "$.data"))


@pytest.mark.parametrize(
    "flag, text",
    [
        ([{"name": "A", "comments": "x"}, {"name": "B", "comments": {}}], "A (x), B"),
        ({"name": "A", "comments": " "}, "A"),
        ({"name": "A", "comments": 5}, "A (5)"),
        ([], None),
        (None, None),
    ],
)
def test_flags_of_any_shape(spark, flag, text):
    df = spark.createDataFrame([(json.dumps(flag),)], "f string").select(F.parse_json("f").alias("f"))
    assert df.select(operations.flags_text("f")).first()[0] == text


def test_flatten(spark):
    df = spark.sql("select 1 as a, named_struct('b', 2, 'c', named_struct('d', 3)) as s, array(1) as l")
    assert N.flatten(df).columns == ["a", "s.b", "s.c.d", "l"]
    assert N.flatten(df, sep="_", max_level=1).columns == ["a", "s_b", "s_c", "l"]


def test_explode_path_carries_parents(spark, rows):
    df = spark.sql(
        "select 7 as result_id, named_struct('item', array(named_struct('x', 1), named_struct('x', 2))) as items "
        "union all select 8, named_struct('item', cast(array() as array<struct<x:int>>))"
    )
    assert rows(N.explode_path(df, "items.item", ["result_id"])) == [(1, 7), (2, 7)]


def test_named_values_last_duplicate_wins(spark):
    df = spark.sql(
        "select array(named_struct('name', 'a', 'value', '1'), named_struct('name', 'b', 'value', '2'), "
        "named_struct('name', 'a', 'value', '3'), named_struct('name', cast(null as string), 'value', '4')) as p"
    )
    assert tuple(N.name_value_columns(df, "p", ["a", "b", "c"]).first()) == ("3", "2", None)
    assert df.select(N.name_value_map("p")).first()[0] == {"a": "3", "b": "2"}


def test_fees(spark, rows):
    fee = {"id": 1, "name": "tax", "value": "10.005", "percent": 0.07, "include_as_tax": 1, "taxable": "x"}
    pay = {"management_commission_amount": "5"}
    df = docs(
        spark,
        {"data": {"taxes_and_fees": {"tax_fee": [fee, {"id": 2, "value": "n/a"}]}, "commission_information": pay}},
        {"data": {"taxes_and_fees": {"tax_fee": []}, "commission_information": pay}},
        {"data": {"taxes_and_fees": {"tax_fee": [fee]}, "commission_information": {}}},
        {"data": {"taxes_and_fees": {"tax_fee": fee}, "commission_information": pay}},
        {"data": {}},
        {"data": {"commission_information": {"other": "x"}}},
        {"data": {"commission_information": []}},
    ).withColumnRenamed("unit_id", "confirmation_id")
    got = rows(rates.taxes_and_fees(df), "confirmation_id", "row_type", "fee_id", "value", "management_commission_amount")
    assert got == sorted(
        [
            (0, "tax_fee", 1, Decimal("10.01"), Decimal("5.00")),
            (0, "tax_fee", 2, None, Decimal("5.00")),
            (0, "commission", None, None, Decimal("5.00")),
            (1, "commission", None, None, Decimal("5.00")),
            (2, "tax_fee", 1, Decimal("10.01"), None),
            (5, "commission", None, None, None),
        ],
        key=repr,
    )
    reasons = [r[0] for r in df.select(N.fee_reject("body")).collect()]
    assert reasons == [None, None, None, "fees not a list", None, None, "commission not an object"]


def test_price_days(spark, rows):
    day = {"date": "13/04/2025", "season": "HIGH", "price": "10.5", "extra": "x", "discount": "1", "original_cost": None}
    df = docs(
        spark,
        {"data": {"reservation_id": 5, "reservation_days": [day, {"date": "2025-04-14", "price": 3}]}},
        {"data": {"reservation_id": 6, "reservation_days": []}},
        {"data": {"reservation_days": [day]}},
        {"data": {"reservation_id": 7, "reservation_days": {"date": "13/04/2025"}}},
        {"data": None},
        "bad",
    )
    got = RP.reservation_price_days(df, load_time(), F.lit("m"))
    assert got.columns == schemas.PRICE_DAYS.names
    assert rows(got, "reservation_id", "date", "price", "extra") == [
        (5, dt.date(2025, 4, 13), 10.5, None),
        (5, dt.date(2025, 4, 14), 3.0, None),
    ]


def page(*records, nested=True):
    return {"data": {"reservations": list(records)}} if nested else {"reservations": list(records)}


def test_reservations_clean(spark):
    first = {"id": 1, "price_nightly": "10.5", "startdate": "1/2/2025", "enddate": "02/30/2025",
             "creation_date": "01/01/2025 10:00:00 EST", "email": "None"}
    df = docs(
        spark,
        page(first, {"id": 2, "price_nightly": "abc", "creation_date": "x XYZ"}),
        page({"id": 1, "price_nightly": "99"}, {"id": 3, "email": ""}, nested=False),
        page(),
        {"data": {}},
    ).withColumnRenamed("unit_id", "page")
    got = {r.id: r for r in RP.reservations_clean(df, "m").collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert (one.price_nightly, one.startdate, one.enddate, one.email) == (Decimal("10.50"), dt.date(2025, 1, 2), None, None)
    assert one.creation_date == dt.datetime(2025, 1, 1, 12, 0) and one.manager == "m"
    assert (got[2].price_nightly, got[2].creation_date) == (None, None)
    assert RP.reservations_clean(df.where("page > 1"), "m").isEmpty()


def test_whole_files_are_documents(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page({"id": i}, {"id": 9}), indent=1))
    pages = documents.read_documents(spark, str(tmp_path))
    assert pages.count() == 3
    records = documents.page_reservations(pages, "body", "file")
    assert sorted(r.id for r in records.collect()) == ["0", "1", "2", "9", "9", "9"]
    clean = RP.reservations_clean(pages, "m", page="file")
    assert sorted(r.id for r in clean.collect()) == [0, 1, 2, 9]


def test_rates_and_targets(spark, rows):
    day = {"date": "06/15/1998", "season": "S", "rate": "5", "minStay": "2", "rate_type": {"rate": "4"}}
    df = docs(spark, {"data": [day, day]}, {"data": []}, {"data": [day]}, "x", manager="m")
    got, rejects = rates.price_rows(df, load_time(), skip_units=(2,))
    assert rows(got, "id_unit", "rate", "`rate_type.rate`") == [(0, "5", "4"), (0, "5", "4")]
    assert rows(rejects, "unit_id", "reason") == [(1, "empty data"), (3, "invalid json")]

    props = spark.createDataFrame([(0, "m", "RENTING"), (1, "m", "RENTING"), (2, "m", "OWNER")], "id int, manager string, renting_type string")
    sheet = spark.createDataFrame([(1, "1.0")], "id_unit int, rate string")
    assert rows(rates.pending_targets(props, sheet)) == [(0, "m")]
    merged = rates.target_rates(sheet, df, props, load_time())
    assert rows(merged, "id_unit", "rate") == [(0, "5"), (0, "5"), (1, "1.0")]


def test_unit_filter_flag(spark, rows):
    fields = [{"field_id": 1, "value": "no"}, {"field_id": 42, "value": "yes"}]
    df = docs(spark, {"data": {"field": fields}}, {"data": {"field": fields[:1]}}, {"data": {"field": []}}, "x", manager="m")
    got, rejects = rates.unit_filter_flag(df, 42, load_time())
    assert rows(got, "id_unit", "field_id", "value") == [(0, 42, "yes")]
    assert rows(rejects, "unit_id", "reason") == [(2, "empty data"), (3, "invalid json")]


def test_referrers(spark, rows):
    df = docs(spark, {"data": {"reservation": {"id": 1, "confirmation_id": "c", "referrer_url": "u"}}}, {"data": {"reservation": [1]}}, {"data": {}}, manager="m")
    got, rejects = rates.referrers(df, load_time())
    assert rows(got, "id", "confirmation_id", "referrer_url") == [(1, None, "u")]
    assert rejects.count() == 2


def test_union_existing(spark, rows):
    a, b = spark.sql("select 1 as id, 'x' as title"), spark.sql("select 1 as id, 'x' as title, 2 as other")
    assert rows(documents.union_existing([a, b], ["title", "id", "none"])) == [("x", 1)]


def test_lists_of_several_folders_in_one_scan(spark, tmp_path):
    for status in ("open", "done"):
        (tmp_path / status).mkdir()
        (tmp_path / status / "a.json").write_text(json.dumps({"data": {"maintenances": {"maintenance": [{"id": status}]}}}, indent=1))
    df = documents.read_json_lists(spark, [str(tmp_path / s) for s in ("open", "done")], schemas.WORK_ORDERS_DOC)
    assert sorted(r.id for r in df.select(F.inline("data.maintenances.maintenance")).collect()) == ["done", "open"]
