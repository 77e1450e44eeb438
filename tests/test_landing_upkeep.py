import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from innkeep.functions.text import collated
from innkeep.operators import distinct
from innkeep.operators.changes import changed_groups
from innkeep.operators.joins import lookup_collated
from innkeep.operators.rows import distinct_collated
from innkeep.plans import rates, stored_by_date, stored_days, unit_days
from innkeep.plans.reservations import reservations_landed
from innkeep.session import partial_keys, scratch_path
from innkeep.sinks import publish, tables
from innkeep.sources import open_records, sheets

# -- undeclared fields --------------------------------------------------------


def pages(spark, *bodies):
    rows = [(1, i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies, 1)]
    return spark.createDataFrame(rows, "run long, page long, body string")


def test_types_come_from_all_records(spark):
    bodies = [
        {"data": {"reservations": [{"id": 1, "a b": 2, "x.y": {"n": 1.5, "t": None}, "l": [1, "z"], "both": 7, "VOID": None}]}},
        {"reservations": [{"id": 2, "both": "seven", "late": True, "x.y": {"t": "s"}}, 5, None]},
    ]
    landed = open_records.land_pages(pages(spark, *bodies, None, "", "<html>", {"reservations": []}), "body", ["$.data.reservations", "$.reservations"], ["page"])
    assert {r["page"]: r["n"] for r in landed.collect()} == {1: 1, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0}
    rows = open_records.typed_records(open_records.page_records(landed, ["page"]), ["page"], ["id", "gone"])
    assert {f.name: f.dataType.simpleString() for f in rows.schema.fields} == {
        "id": "string", "gone": "string", "VOID": "string", "a b": "bigint", "both": "string", "l": "string", "late": "boolean",
        "x.y.n": "double", "x.y.t": "string", "page": "bigint",
    }
    got = {r["id"]: r.asDict() for r in rows.collect()}
    assert got["1"]["x.y.n"] == 1.5 and got["1"]["l"] == '["1","z"]' and got["1"]["both"] == "7"
    assert got["2"]["both"] == "seven" and got["2"]["late"] is True and got["2"]["x.y.t"] == "s"


def test_a_run_ends_at_its_first_short_page(spark):
    full = {"reservations": [{"id": 1}, {"id": 2}]}
    df = pages(spark, full, full, {"reservations": [{"id": 3}]}, full, {"reservations": []})
    two = df.unionByName(df.withColumn("run", F.lit(2)).where("page <= 2"))
    landed = open_records.land_pages(two, "body", ["$.reservations"], ["run", "page"])
    kept = open_records.until_short_page(landed, "page", 2, "run")
    assert sorted((r["run"], r["page"]) for r in kept.collect()) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    one = open_records.until_short_page(landed.where("run = 1"), "page", 2)
    assert one.count() == 3 and open_records.until_short_page(landed.where("run = 2"), "page", 2).count() == 2


def test_landed_reservations_keep_declared_and_other_fields(spark):
    first = {"id": 5, "price_nightly": "12.5", "startdate": "06/15/2025", "guest": {"vip": True}, "startDay": "x"}
    df = pages(spark, {"reservations": [first]}, {"data": {"reservations": [{**first, "price_nightly": 1}, {"id": 6, "new": 3}]}})
    rows = reservations_landed(df, "me", run="run")
    got = {r["id"]: r.asDict() for r in rows.collect()}
    assert set(got) == {5, 6} and got[5]["price_nightly"] == 12.5 and got[5]["startdate"] == dt.date(2025, 6, 15)
    assert got[5]["guest_vip"] is True and got[6]["new"] == 3 and got[6]["email"] is None and got[5]["manager"] == "me"
    assert reservations_landed(pages(spark, None), "me").count() == 0


def test_houses_from_responses(spark):
    docs = pages(spark, {"data": {"property": [{"id": 1, "since": "2020-01-31", "note": "x"}]}}, {"status": {"code": "E1"}}, None)
    houses, rejects = rates.active_houses_landed(docs, F.lit("2025-01-01").cast("date"))
    assert [r.asDict() for r in houses.collect()] == [
        {"id": 1, "note": "x", "since": dt.date(2020, 1, 31), "data_load": dt.date(2025, 1, 1)}
    ]
    assert sorted(r["reason"] for r in rejects.collect()) == ["empty body", "status E1"]


# -- sheets, names, sketches --------------------------------------------------


def test_sheet_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,day,who\n1,2020-01-02,"a, b"\n2,soon,c\n3,2020-01-03\n4,2020-01-04,d,e\nx,y,z\n5,,\n')
    schema = T.StructType.fromDDL("id int, day date, who string")
    rows, rejects = sheets.read_sheet_checked(spark, str(tmp_path), schema)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, dt.date(2020, 1, 2), "a, b"), (5, None, None)]
    assert sorted((r["line"], r["reason"]) for r in rejects.collect()) == [
        ("2,soon,c", "not parsed: day"), ("3,2020-01-03", "too few cells"), ("4,2020-01-04,d,e", "too many cells"),
        ("x,y,z", "not parsed: id, day"),
    ]


def test_collated_names(spark):
    names = ["Thị ", "THI", "Straße", "STRASSE", "Ελλάδα", "ΕΛΛΑΔΑ", "Москва", "москва", "", None, "  x", "x"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    got = {(r["name"], r["spellings"], r["n_rows"]) for r in distinct_collated(df, ["name"]).collect()}
    assert got == {("THI", 2, 2), ("STRASSE", 2, 2), ("ΕΛΛΑΔΑ", 2, 2), ("Москва", 2, 2), ("", 1, 1), (None, 1, 1), ("  x", 1, 1), ("x", 1, 1)}
    dim = spark.createDataFrame([("thí", 1), ("strasse  ", 2), (None, 3)], "key string, v int")
    found = {r["name"]: r["v"] for r in lookup_collated(df, dim, {"name": "key"}, {"v": "v"}).collect()}
    assert found["Thị "] == found["THI"] == 1 and found["Straße"] == 2 and found[None] is None and found["x"] is None
    assert df.where(collated("name") == "МОСКВА").count() == 2


def test_sketches_of_loads_unite(spark):
    path = scratch_path(spark, "sketches")
    for load, (lo, hi) in enumerate([(0, 6000), (4000, 9000), (4000, 9000)]):
        rows = spark.range(lo, hi).withColumn("g", F.col("id") % 2)
        distinct.append_sketches(distinct.load_sketches(rows, ["id"], ["g"]), path, str(min(load, 1)))
    for r in distinct.estimates(spark.read.parquet(path), ["id"], ["g"]).collect():
        assert abs(r["id"] - 4500) <= 4 * distinct.standard_error() * 4500


# -- publishing, buckets, upkeep ----------------------------------------------


def test_a_load_is_read_once_and_judged_by_what_was_written(spark):
    root = scratch_path(spark, "published")
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    def load(n, price=1.0):
        rows = spark.range(n).select("id", F.lit(price).alias("price"))
        return rows.mapInArrow(counting, rows.schema)

    assert not publish.publish_checked(load(100), root, "price").published  # nothing to compare with
    for rows, want in ((load(100), True), (load(104), True), (load(0), False), (load(103), False), (load(104, 2.0), False), (load(200), False)):
        before = reads.value
        verdict = publish.publish_checked(rows, root, "price", bootstrap=True)
        gate = verdict.gate.first()
        assert verdict.published == want and reads.value - before == gate["new_rows"]
    assert publish.read_published(spark, root).count() == 104
    assert publish.publish(load(300).drop("price"), root)  # without measures: the next check reads it
    assert publish.publish_checked(load(301), root, "price").published is False  # columns differ
    assert publish.publish_checked(load(301).drop("price"), root, "price").published


def test_changed_groups(spark):
    shape = "k string, a int, b int"
    old = [("same", 1, 2), ("same", 1, 2), ("moved", None, 1), ("fewer", 1, 1), ("fewer", 1, 1), ("gone", 1, 1), (None, 1, 1)]
    new = [("same", 1, 2), ("same", 1, 2), ("moved", 1, None), ("fewer", 1, 1), ("new", 1, 1), (None, 1, 2)]
    got = changed_groups(spark.createDataFrame(old, shape), spark.createDataFrame(new, shape), ["k"])
    assert {r["k"] for r in got.collect()} == {"moved", "fewer", "gone", "new", None}


def test_partitions_are_replaced_and_removed(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "v int, p string")
    tables.overwrite_partitions(df, path, ["p"], df.select("p"))
    touched = spark.createDataFrame([("a",), (None,), ("e",), ("f",)], "p string")
    assert tables.overwrite_partitions(spark.createDataFrame([(9, "a"), (8, "e")], "v int, p string"), path, ["p"], touched) == 4
    assert sorted((r["v"], r["p"]) for r in spark.read.parquet(path).collect()) == [(2, "b"), (4, "d"), (8, "e"), (9, "a")]
    with pytest.raises(ValueError):
        tables.overwrite_partitions(df, path, ["p"], touched)


START, END = dt.date(2025, 1, 1), dt.date(2025, 3, 31)
SALE = "id long, unit_id long, manager string, date date, type_name string, creation_date date, price double"
RATE = "id_unit long, manager string, date date, season string, rate double, min_stay long"


def day_inputs(spark, hot=400):
    units = [(i, "M" if i % 2 else "N", "name", "place", 1, 1, "c", "g", 2, "RENTING") for i in range(1, 12)]
    names = "id long, manager string, name string, location_name string, bedrooms_number int, bathrooms_number int, "
    houses = spark.createDataFrame(units, names + "condo_type_name string, condo_type_group_name string, max_adults int, renting_type string")
    days = [START + dt.timedelta(days=i) for i in range(-3, 95)]
    sales = [(u * 1000 + i, u, "M" if u % 2 else "n ", d, "t", START, 5.0) for u in range(1, 12) for i, d in enumerate(days) if (i + u) % 5 == 0]
    sales += [(90_000 + i, 3, "M", days[i % 60], "t", START, 1.0) for i in range(hot)]  # a unit with most rows
    rate = [(u, "M" if u % 2 else "N", d, "s", float(u), 1) for u in range(1, 12) for d in days]
    seasons = spark.createDataFrame([(m, d, 1, "HIGH") for m in "MN" for d in days], "manager string, date date, occupancy int, season string")
    sales, rate = spark.createDataFrame(sales, SALE), spark.createDataFrame(rate, RATE)
    return unit_days.Inputs(houses, sales.select("id", "unit_id", "manager"), sales, rate, rate, seasons, houses)


def base_source(data):
    units, sales = unit_days.base_parts(data)
    return stored_days.DaySource(units, sales, data.target_rates, data.prices, {"seasons": (data.seasons, "date")}, {})


def shown(df):
    return sorted((repr(sorted(r.asDict().items())) for r in df.drop(*stored_days.PARTITION).collect()))


def test_stored_marts_join_without_shuffle(spark):
    data = day_inputs(spark)
    tables_ = stored_days.store_day_tables(base_source(data), START, END, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with partial_keys(spark):
            plan = stored_days.stored_day_rows(spark, tables_, START, END)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        stored_days.drop_day_tables(spark, tables_)
    assert plan.count("Join") >= 6 and "Exchange" not in plan


def test_upkeep_equals_a_full_build(spark):
    from dataclasses import replace
    from functools import partial

    new, path = day_inputs(spark), scratch_path(spark, "unit-days")
    late = F.col("date") >= F.lit("2025-03-05").cast("date")
    old = replace(
        new,
        sales=new.sales.where("not (unit_id = 3 and month(date) = 2)"),
        target_rates=new.target_rates.withColumn("rate", F.col("rate") + F.when(late & (F.col("id_unit") == 5), 1).otherwise(0)),
        houses=new.houses.where("id <> 7"),
    )
    total = stored_days.build_unit_days(base_source(old), partial(unit_days.finish_base, seasons=old.seasons), path, START, END, 4)
    done = stored_days.refresh_unit_days(base_source(old), base_source(new), partial(unit_days.finish_base, seasons=new.seasons), path, START, END, 4)
    assert 0 < done < total == 3 * stored_days.UNIT_GROUPS
    full = unit_days.unit_day_base(new, START, END)
    assert shown(spark.read.parquet(path)) == shown(full)
    # a unit that is listed no more, and nothing at all
    less = replace(new, properties=new.properties.where("id <> 9"), reservations=new.reservations.where("unit_id <> 9"))
    finish = partial(unit_days.finish_base, seasons=new.seasons)
    assert stored_days.refresh_unit_days(base_source(new), base_source(less), finish, path, START, END, 4) == 3
    assert shown(spark.read.parquet(path)) == shown(unit_days.unit_day_base(less, START, END))
    assert stored_days.refresh_unit_days(base_source(less), base_source(less), finish, path, START, END, 4) == 0


def test_stored_marts_are_finished_part_by_part(spark):
    """Free days, nearly all rows, are finished where Spark knows that they have no sale."""
    data, seen = day_inputs(spark), []

    def finish(rows):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString().splitlines()[0])
        return unit_days.finish_base(rows, data.seasons)

    path = scratch_path(spark, "unit-days")
    stored_days.build_unit_days(base_source(data), finish, path, START, END, 4)
    assert len(seen) == 2 and sum("null AS reservation" in plan for plan in seen) == 1
    assert not {"_unit", "_manager", "_month"} & set(spark.read.parquet(path).columns)


def test_by_date_upkeep(spark):
    def source(price, unit, mirror):
        rows = [(i, unit if i == 4 else i % 3, 5, START + dt.timedelta(days=40 * (i % 5)), None if i == 8 else START) for i in range(10)]
        res = spark.createDataFrame(rows, "id long, unit_id long, status_id long, startdate date, creation_date date")
        days = [(i % 10, START + dt.timedelta(days=i), price if i % 10 == 2 else 1.0, dt.datetime(2025, 1, 1 + i % 2)) for i in range(60)]
        prices = spark.createDataFrame(days, "reservation_id long, date date, price double, data_price timestamp_ntz")
        mirrors = spark.createDataFrame([(77, mirror)], "from_id long, to_id long")
        return stored_by_date.ByDateSource(res, prices, mirrors, spark.createDataFrame([(1, START)], "id long, creation_date date"))

    path = scratch_path(spark, "by-date")
    first = source(1.0, 1, 5)
    assert stored_by_date.build_by_date(first, path) == 5
    for now, touched in ((source(2.0, 1, 5), 1), (source(2.0, 77, 5), 1), (source(2.0, 77, 6), 1), (source(2.0, 77, 6), 0)):
        assert stored_by_date.refresh_by_date(first, now, path) == touched
        full = scratch_path(spark, "by-date")
        stored_by_date.build_by_date(now, full)
        assert shown(spark.read.parquet(path)) == shown(spark.read.parquet(full))
        first = now


def test_a_change_may_reach_every_month(spark, tmp_path):
    """In large tables the changes of ``by_date_upkept`` reach all arrival months."""
    from innkeep.domain.queries_upkeep import by_date_upkept

    day = dt.datetime(1995, 1, 1)
    orders = [(5003 * i, 1, "F", 10.0, day + dt.timedelta(days=31 * i), "5-LOW") for i in range(1, 6)]
    items = [(5003 * i, 1, day, "N", 5.0, 0.1, 0.0, 1.0) for i in range(1, 6)]
    spark.createDataFrame([(1, "BUILDING", 0.0)], "c_custkey long, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    shape = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, shape).write.parquet(f"{tmp_path}/orders.parquet")
    shape = "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_returnflag string, l_extendedprice double, l_tax double, l_discount double, l_quantity double"
    spark.createDataFrame(items, shape).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = by_date_upkept(spark, str(tmp_path)).collect()
    assert sorted((r["id"], r["price"]) for r in got) == [(5003 * i, 5.0) for i in range(1, 6)]


def test_a_record_is_read_in_one_walk(spark):
    odd = {"id": 1, "it's": 2, '"q"': 3, "both ' and \"": 4, "a b": {"c.d": [1], "e": None}, "gone": None}
    landed = open_records.land_pages(pages(spark, {"reservations": [odd, {"id": "two"}, [1], "x", None, {}]}), "body", ["$.reservations"], ["page"])
    records = open_records.page_records(landed, ["page"])
    assert sorted(r["pos"] for r in records.collect()) == [0, 1, 5]
    rows = open_records.typed_records(records, ["pos"], ["id", "late"])
    assert sum(c.count("variant_get") for c in rows._jdf.queryExecution().analyzed().toString().split("Project")) <= 2
    got = {r["pos"]: r.asDict() for r in rows.collect()}
    assert got[0] == {"id": "1", "late": None, "it's": 2, '"q"': 3, "both ' and \"": 4, "a b.c.d": "[1]", "a b.e": None, "gone": None, "pos": 0}
    assert got[1]["id"] == "two" and got[1]["it's"] is None and got[5]["id"] is None
