"""Queries of landing: responses with undeclared fields, runs of pages, price loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from innkeep.domain import views as V
from innkeep.domain.queries_documents import _bookings, _rate_docs, _us
from innkeep.domain.registry import query
from innkeep.operators import distinct
from innkeep.plans import rates, reservations as RP
from innkeep.session import scratch_path, stored
from innkeep.sinks import publish
from innkeep.sources import sheets
from innkeep.sources.documents import read_documents
from innkeep.streaming.landing import once_within, replace_days, stream_documents

PAGE_SIZE = 40

_CREATED = """CAST(creation_date AS TIMESTAMP) + INTERVAL 15 HOUR + INTERVAL 30 MINUTE
               - CASE WHEN timezone('America/Sao_Paulo', timezone('UTC', CAST(creation_date AS TIMESTAMP)
                        + INTERVAL 15 HOUR + INTERVAL 30 MINUTE))
                    = CAST(creation_date AS TIMESTAMP) + INTERVAL 13 HOUR + INTERVAL 30 MINUTE
                 THEN INTERVAL 2 HOUR ELSE INTERVAL 3 HOUR END"""


def _page_runs(spark, sf) -> DataFrame:
    """A run of pages per group of clients.  Records hold fields that no schema declares,
    and the first one of a page comes twice, the second time with another price.  A run
    ends with an empty page; a page of an earlier request lies behind it."""
    rows = _bookings(spark, sf).withColumn("run", F.col("client_id") % 97)
    rows = rows.withColumn("k", F.row_number().over(W.partitionBy("run").orderBy("id")) - 1)
    record = F.struct(
        *["id", "confirmation_id", "unit_id", "client_id", "occupants", "occupants_small", "days_number"],
        *["status_code", "status_id", "type_name", "maketype_description", "email", "first_name", "last_name"],
        F.col("price_nightly").cast("decimal(18,2)").alias("price_nightly"),
        F.col("price_total").cast("decimal(18,2)").cast("string").alias("price_total"),
        F.concat(F.date_format("creation_date", "MM/dd/yyyy"), F.lit(" 10:30:00 EST")).alias("creation_date"),
        F.concat(F.date_format("last_updated", "yyyy-MM-dd"), F.lit(" 23:15:00")).alias("last_updated"),
        _us("startdate").alias("startdate"),
        _us("enddate").alias("enddate"),
        F.struct(
            F.concat(F.lit("country "), (F.col("unit_id") % 5).cast("string")).alias("home country"),
            (F.col("days_number") / 2).alias("score"),
        ).alias("guest"),
        F.array(F.col("occupants"), F.col("occupants_small")).alias("party"),
        F.when(F.col("status_id") == 5, F.col("client_id") * 3).alias("loyalty"),
        (F.col("status_id") == 8).alias("cancelled"),
    )
    listed = rows.groupBy("run", (F.floor(F.col("k") / PAGE_SIZE) + 1).alias("page")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", record.alias("r")))), lambda x: x["r"]).alias("records")
    )
    again = F.transform(F.slice("records", 1, 1), lambda r: r.withField("price_nightly", F.lit(1).cast("decimal(18,2)")))
    full = listed.select("run", "page", F.concat("records", again).alias("records"))
    last = listed.groupBy("run").agg(F.max("page").alias("last"))
    old = F.array(F.struct(F.lit(-1).alias("id"), F.lit("never").alias("stale")))
    pages = (
        full.select("run", "page", F.when(F.col("run") % 2 == 0, F.to_json(F.struct(F.struct("records").alias("data")))).otherwise(F.to_json(F.struct("records"))).alias("body"))
        .unionByName(last.select("run", (F.col("last") + 1).alias("page"), F.lit('{"data": {"records": []}}').alias("body")))
        .unionByName(last.select("run", (F.col("last") + 2).alias("page"), F.to_json(F.struct(old.alias("records"))).alias("body")))
    )
    return stored(pages.withColumn("body", F.replace("body", F.lit('"records":'), F.lit('"reservations":'))), "page-runs")


@query(
    "reservations",
    f"""SELECT id, confirmation_id, unit_id, client_id, occupants, occupants_small, days_number, status_code,
           status_id, type_name, maketype_description, CAST(NULL AS VARCHAR) AS hear_about_name,
           CAST(NULL AS VARCHAR) AS travelagent_name, CAST(NULL AS VARCHAR) AS location_name, email, first_name,
           last_name, CAST(CAST(price_nightly AS DECIMAL(18,2)) AS DOUBLE) AS price_nightly,
           CAST(CAST(price_total AS DECIMAL(18,2)) AS DOUBLE) AS price_total, CAST(NULL AS DOUBLE) AS price_paidsum,
           CAST(NULL AS DOUBLE) AS price_common, CAST(NULL AS DOUBLE) AS price_balance, {_CREATED} AS creation_date,
           timezone('America/Sao_Paulo', timezone('UTC', CAST(last_updated AS TIMESTAMP)
               + INTERVAL 23 HOUR + INTERVAL 15 MINUTE)) AS last_updated,
           startdate, enddate, status_id = 8 AS cancelled, 'country ' || (unit_id % 5) AS guest_home_country,
           days_number / 2 AS guest_score, CASE WHEN status_id = 5 THEN client_id * 3 END AS loyalty,
           '[' || occupants || ',' || occupants_small || ']' AS party, 'main office' AS manager
    FROM reservations""",
)
def landed_reservations(spark, sf):
    """Reservations from runs of pages, each read to its end, with all declared columns
    and, typed, the fields that no schema declares."""
    return RP.reservations_landed(_page_runs(spark, sf), "main office", PAGE_SIZE, "run")


#: Properties in one response.
RESPONSE_SIZE = 500


@query(
    "listed_units",
    """SELECT CAST(id AS BIGINT) AS id, name, location_name AS "place.name", id / 4 AS "place.height above sea",
           '[' || bedrooms_number || ',' || bathrooms_number || ']' AS rooms,
           DATE '1998-01-01' + CAST(id % 100 AS INTEGER) AS since, manager || ' 1998-01-01' AS note,
           CASE WHEN id % 3 = 0 THEN max_adults END AS beds, renting_type = 'RENTING' AS rented,
           CASE WHEN id % 2 = 0 THEN CAST(id AS VARCHAR) ELSE 'no ' || id END AS code,
           TIMESTAMP '1998-06-15 02:00:00' AS data_load
    FROM listed_units""",
)
def active_houses_landed(spark, sf):
    """Active houses from response files, read whole: fields, nesting and types as the
    responses have them.  ``code`` is a number in some and text in others."""
    path = scratch_path(spark, "properties")
    since = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 100).cast("int"))
    record = F.to_json(
        F.struct(
            "id",
            "name",
            F.struct(F.col("location_name").alias("name"), (F.col("id") / 4).alias("height above sea")).alias("place"),
            F.array("bedrooms_number", "bathrooms_number").alias("rooms"),
            F.date_format(since, "yyyy-MM-dd").alias("since"),
            F.concat("manager", F.lit(" 1998-01-01")).alias("note"),
            F.when(F.col("id") % 3 == 0, F.col("max_adults")).alias("beds"),
            (F.col("renting_type") == "RENTING").alias("rented"),
        )
    )
    code = F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise(F.concat(F.lit('"no '), F.col("id").cast("string"), F.lit('"')))
    text = F.concat(F.left(record, F.length(record) - 1), F.lit(', "code": '), code, F.lit("}"))
    rows = V.listed_units(spark, sf).select(F.floor(F.col("id") / RESPONSE_SIZE).alias("part"), text.alias("record"))
    bodies = rows.groupBy("part").agg(F.concat(F.lit('{"data": {"property": ['), F.listagg("record", F.lit(",\n")), F.lit("]}}")).alias("value"))
    broken = spark.range(1).select(F.lit(-1).cast("bigint").alias("part"), F.lit('{"status": {"code": "E0013"}}').alias("value"))
    bodies.unionByName(broken).repartition("part").write.partitionBy("part").text(path)
    houses, rejects = rates.active_houses_landed(read_documents(spark, f"{path}/*/*.txt"), V.load_time())
    if rejects.count() != 1:
        raise ValueError("one response is an error")
    return houses


@query(
    "sales",
    "SELECT id, unit_id, type_name, price_nightly, creation_date, startdate, enddate, manager, date, price, season, reservation_id FROM sales",
)
def published_by_date(spark, sf):
    """The whole chain: pages landed, the load checked while it is written, published,
    and by-date rows built from the published table.  A load that shrinks is refused."""
    root = scratch_path(spark, "reservations")
    clean = RP.reservations_landed(_page_runs(spark, sf), "main office", PAGE_SIZE, "run")
    managers = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("unit_id"), F.col("c_mktsegment").alias("manager"))
    load = stored(clean.drop("manager").join(managers, "unit_id", "left"), "load")
    before = load.where("startdate < date'2001-05-01'")
    runs = [
        publish.publish_checked(before, root, "price_nightly", bootstrap=True),
        publish.publish_checked(before.where("status_id = 8"), root, "price_nightly"),
        publish.publish_checked(load.drop("email"), root, "price_nightly"),
        publish.publish_checked(load, root, "price_nightly"),
    ]
    if [run.published for run in runs] != [True, False, False, True]:
        raise ValueError("loads were not judged as they should be")
    by_date = RP.reservations_by_date(
        publish.read_published(spark, root),
        V.price_days(spark, sf),
        V.mirror_units(spark, sf),
        V.booking_patches(spark, sf),
    )
    return by_date.select(
        "id", "unit_id", "type_name", F.col("price_nightly"), F.col("creation_date").cast("date").alias("creation_date"),
        "startdate", "enddate", "manager", "date", "price", "season", "reservation_id",
    )


@query(
    "listed_units",
    """WITH loads AS (
        SELECT *, unnest([DATE '1998-06-13', DATE '1998-06-14']) AS load FROM listed_units),
    prices AS (
        SELECT id AS id_unit, manager, load, '06/15/1998' AS date, location_name AS season,
               CAST(balance AS VARCHAR) AS rate, CAST(max_adults AS VARCHAR) AS "minStay", 'BASE' AS rate_type_season,
               unnest([1, 2]) AS n
        FROM loads WHERE load = DATE '1998-06-13' OR id % 2 = 0)
    SELECT id_unit, manager, date, season, rate, "minStay", rate_type_season, load, 'history' AS copy FROM prices
    UNION ALL
    SELECT id_unit, manager, date, season, rate, "minStay", rate_type_season, NULL, 'current' FROM prices WHERE load = DATE '1998-06-14'""",
)
def price_loads(spark, sf):
    """Price responses through rows into history and current table: two loads, the
    second one run twice, and one without any price."""
    history, current = scratch_path(spark, "history"), scratch_path(spark, "current")
    docs = _rate_docs(spark, sf).drop("balance")
    some = docs.where("unit_id % 2 = 0")
    for day, bodies in ((13, docs), (14, some), (14, some), (15, docs.withColumn("body", F.lit('{"data": []}')))):
        load = dt.date(1998, 6, day)
        rates.load_prices(bodies, F.lit(load).cast("timestamp_ntz"), load.isoformat(), history, current)
    columns = ["id_unit", "manager", "date", "season", "rate", "minStay", "rate_type_season"]
    kept = spark.read.parquet(history).select(*columns, F.col("load").cast("date").alias("load"), F.lit("history").alias("copy"))
    now = spark.read.parquet(current).select(*columns, F.lit(None).cast("date").alias("load"), F.lit("current").alias("copy"))
    return kept.unionByName(now)


@query(
    "reservations",
    """SELECT manager, count(DISTINCT unit_id) AS units, count(DISTINCT email) AS guests, true AS units_near, true AS guests_near
    FROM reservations GROUP BY manager""",
)
def distinct_over_loads(spark, sf):
    """Distinct units and guests per manager over three loads: exactly, and whether the
    united sketches of the loads are within four standard errors of that."""
    path = scratch_path(spark, "sketches")
    rows = V.reservations(spark, sf)
    columns = ["unit_id", "email"]
    for code in (4, 5, 8, 5):  # the same load again replaces itself
        load = rows.where(F.col("status_id") == code)
        distinct.append_sketches(distinct.load_sketches(load, columns, ["manager"]), path, f"status {code}")
    found = distinct.estimates(spark.read.parquet(path), columns, ["manager"])
    exact = rows.groupBy(F.col("manager").alias("_m")).agg(F.count_distinct("unit_id").alias("units"), F.count_distinct("email").alias("guests"))
    margin = 4 * distinct.standard_error()
    near = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= F.col(n) * margin
    both = exact.join(found, F.col("_m") == F.col("manager"))
    return both.select("manager", "units", "guests", near("unit_id", "units").alias("units_near"), near("email", "guests").alias("guests_near"))


@query(
    "units",
    """SELECT id, manager, CASE WHEN id % 7 > 0 THEN since END AS since, balance, 'row' AS kind,
           CAST(NULL AS VARCHAR) AS reason
    FROM (SELECT *, DATE '1998-01-01' + CAST(id % 100 AS INTEGER) AS since FROM units) WHERE id % 11 > 3
    UNION ALL
    SELECT id, NULL, NULL, NULL, 'reject', CASE id % 11 WHEN 0 THEN 'not parsed: balance' WHEN 1 THEN 'too many cells'
           WHEN 2 THEN 'not parsed: since, balance' ELSE 'too few cells' END
    FROM units WHERE id % 11 <= 3""",
)
def sheet_rows_and_rejects(spark, sf):
    """A sheet with malformed rows: what parses, and the lines that don't with a reason."""
    path = scratch_path(spark, "sheet")
    rows = V.units(spark, sf)
    kind = F.col("id") % 11
    since = F.date_format(F.date_add(F.lit(dt.date(1998, 1, 1)), (F.col("id") % 100).cast("int")), "yyyy-MM-dd")
    cells = F.array(
        F.col("id").cast("string"),
        F.concat(F.lit('"'), "manager", F.lit('"')),
        F.when(kind == 2, "soon").when(F.col("id") % 7 == 0, "").otherwise(since),
        F.when(kind.isin(0, 2), "n/a").otherwise(F.col("balance").cast("string")),
    )
    line = F.concat_ws(",", F.when(kind == 3, F.slice(cells, 1, 3)).otherwise(cells))
    line = F.concat(line, F.when(kind == 1, ",more").otherwise(""))
    # a header line in front of each file's rows
    head = F.lit("id,manager,since,balance")
    parts = rows.select(F.pmod("id", F.lit(4)).alias("part"), F.col("id").alias("row"), line.alias("value"))
    heads = spark.range(4).select(F.col("id").alias("part"), F.lit(-1).cast("bigint").alias("row"), head.alias("value"))
    every = heads.unionByName(parts).repartition("part").sortWithinPartitions("part", "row")
    every.select("part", "value").write.partitionBy("part").text(path)
    schema = T.StructType.fromDDL("id bigint, manager string, since date, balance double")
    good, bad = sheets.read_sheet_checked(spark, f"{path}/*", schema)
    rejects = bad.select(F.split("line", ",")[0].cast("bigint").alias("id"), F.lit("reject").alias("kind"), "reason")
    return good.withColumn("kind", F.lit("row")).unionByName(rejects, allowMissingColumns=True)


@query(
    "",
    """SELECT o_orderkey AS reservation_id, CAST(o_orderdate AS DATE) AS date,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS price
    FROM orders""",
)
def arrivals_stateful(spark, sf):
    """Arrivals streamed into a table by month.  Documents that arrive twice are taken
    once; corrected ones replace their arrival; a batch that runs again changes nothing."""
    landing, table, offsets = (scratch_path(spark, n) for n in ("landing", "arrivals", "offsets"))
    orders = V.table(spark, sf, "orders").repartition("o_orderkey")

    def land(rows: DataFrame, price, at: str) -> None:
        arrival = F.struct(
            F.col("o_orderkey").alias("reservation_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            price.alias("price"), F.lit(at).alias("sent"),
        )
        rows.select(F.to_json(arrival).alias("value")).write.mode("append").text(landing)

    def run(checkpoint: str) -> None:
        shape = "reservation_id bigint, date date, price double, sent timestamp"
        docs = stream_documents(spark, landing, whole_files=False).select(F.from_json("body", shape).alias("d")).select("d.*")
        docs = docs.withColumn("month", F.trunc("date", "MM"))
        once = once_within(docs, ["reservation_id", "sent"], "sent", "2 hours")
        replace_days(once, "month", ["reservation_id"], "sent", table, checkpoint).awaitTermination()

    land(orders, F.col("o_totalprice"), "1998-06-15 02:00:00")
    land(orders.where("o_orderstatus = 'F'"), F.col("o_totalprice"), "1998-06-15 02:00:00")
    run(f"{offsets}/a")
    land(orders.where("o_orderstatus = 'F'"), F.col("o_totalprice") + 1, "1998-06-15 03:00:00")
    run(f"{offsets}/a")
    run(f"{offsets}/b")  # without its offsets it takes everything again
    return spark.read.parquet(table).select("reservation_id", "date", "price")
