"""Queries of the readers and writers: each writes below the shared folder,
reads back what is there and returns it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from innkeep import schemas
from innkeep.domain import views as V
from innkeep.domain.queries_documents import _grid, _pages
from innkeep.domain.registry import query
from innkeep.operators.nested import split_documents
from innkeep.operators.quality import has_key, quality_gate
from innkeep.plans.sheets import reference_sheets as load_sheets
from innkeep.session import scratch_path
from innkeep.sinks import export, publish, snapshots, tables
from innkeep.sources import documents, sheets
from innkeep.sources.tables import read_table
from innkeep.streaming.landing import append_price_days, stream_documents

_DAY1, _DAY2 = dt.date(1998, 6, 14), dt.date(1998, 6, 15)
_RUN = dt.datetime(1998, 6, 15, 6, 0)


def _small(spark, sf):
    return V.bookings(spark, sf).select("id", "unit_id", "status_id", "startdate", "price_nightly")


_COLUMNS = "id, unit_id, status_id, startdate, price_nightly"


@query(
    "reservations",
    f"""SELECT {_COLUMNS} FROM reservations""",
)
def publish_swap(spark, sf):
    """Staged publish: an empty load and a refused load leave the table alone,
    an accepted one replaces it."""
    root = scratch_path(spark, "published")
    new = _small(spark, sf)
    base = new.where("startdate < date'2001-05-01'")
    taken = [publish.publish(base, root), publish.publish(base.where("false"), root)]
    shrunk = quality_gate(base.where("status_id = 4"), publish.read_published(spark, root), "price_nightly")
    taken.append(publish.publish_if(shrunk, base.where("status_id = 4"), root))
    gate = quality_gate(new, publish.read_published(spark, root), "price_nightly")
    taken.append(publish.publish_if(gate, new, root))
    assert [bool(x) for x in taken] == [True, False, False, True]
    return publish.read_published(spark, root)


@query(
    "reservations",
    """SELECT 'reservations' AS table_name, 'load' AS source_job, TIMESTAMP '1998-06-15 06:00:00' AS run_at,
           CAST(n BETWEEN b AND b * 1.05 AND abs(s - bs) <= abs(bs) * 0.10 AS BIGINT) AS status
    FROM (SELECT count(*) AS n, sum(price_nightly) AS s FROM reservations),
         (SELECT count(*) AS b, sum(price_nightly) AS bs FROM reservations WHERE startdate < DATE '2001-05-01')
    UNION ALL SELECT 'reservations', 'load', TIMESTAMP '1998-06-15 07:00:00', 0""",
)
def check_log(spark, sf):
    """One log row per gate run."""
    path = scratch_path(spark, "log")
    new = _small(spark, sf)
    base = new.where("startdate < date'2001-05-01'")
    log = tables.log_check
    log(quality_gate(new, base, "price_nightly"), path, "reservations", "load", _RUN)
    log(quality_gate(base, new, "price_nightly"), path, "reservations", "load", _RUN.replace(hour=7))
    return spark.read.parquet(path)


@query(
    "reservations",
    f"""SELECT {_COLUMNS}, DATE '1998-06-14' AS extraction_day FROM reservations
    UNION ALL
    SELECT {_COLUMNS}, DATE '1998-06-15' FROM reservations WHERE status_id IN (5, 8)""",
)
def snapshot_replace_day(spark, sf):
    """Daily snapshots: a second run replaces its own day only, an empty run
    nothing."""
    path = scratch_path(spark, "snapshots")
    rows = _small(spark, sf)
    snapshots.snapshot_replace(rows, path, _DAY1)
    snapshots.snapshot_replace(rows.where("status_id = 4"), path, _DAY2)
    snapshots.snapshot_replace(rows.where("status_id in (5, 8)"), path, _DAY2)
    snapshots.snapshot_replace(rows.where("false"), path, _DAY1)
    return spark.read.parquet(path)


@query(
    "reservations",
    """SELECT unit_id, min(startdate) AS startdate, DATE '1998-06-14' AS extraction_day
    FROM reservations GROUP BY unit_id
    UNION ALL
    SELECT unit_id, min(startdate), DATE '1998-06-15' FROM reservations WHERE status_id = 5 GROUP BY unit_id""",
)
def snapshot_insert_absent(spark, sf):
    """Daily snapshots written once: later runs of the day are skipped and
    repeated keys keep their first row."""
    path = scratch_path(spark, "once")
    rows = _small(spark, sf).select("unit_id", "startdate", "status_id")

    def write(part, day):
        rows_of = part.select("unit_id", "startdate")
        return snapshots.snapshot_if_absent(rows_of, path, day, ["unit_id"], ["startdate"])

    parts = [(rows, _DAY1), (rows.where("status_id = 4"), _DAY1), (rows.where("status_id = 5"), _DAY2)]
    written = [write(part, day) for part, day in parts]
    assert [bool(x) for x in written] == [True, False, True]
    return spark.read.parquet(path)


@query(
    "",
    """SELECT l_orderkey AS reservation_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS price,
           'current' AS copy FROM lineitem WHERE l_linenumber % 2 = 1
    UNION ALL
    SELECT l_orderkey, CAST(l_shipdate AS DATE), l_extendedprice, 'history' FROM lineitem""",
)
def price_history_current(spark, sf):
    """Price table replaced by each load, its history appended to."""
    history, current = scratch_path(spark, "history"), scratch_path(spark, "current")
    prices = V.price_days(spark, sf)
    for day in (dt.date(1998, 6, 13), dt.date(1998, 6, 14)):
        load = prices.where(F.to_date("data_price") == F.lit(day)).select("reservation_id", "date", "price")
        tables.write_history_and_current(load, history, current, day.isoformat())
    now = spark.read.parquet(current).withColumn("copy", F.lit("current"))
    every = spark.read.parquet(history).drop("load")
    return now.unionByName(every.withColumn("copy", F.lit("history")))


@query(
    "reservations",
    """SELECT id, unit_id, CASE WHEN status_id <> 4 THEN price_nightly END AS rate FROM reservations""",
)
def evolved_table(spark, sf):
    """Table created empty from a schema, appended to, then with a new column."""
    path = scratch_path(spark, "evolved")
    rows = _small(spark, sf)
    empty = tables.ensure_like(spark, path, rows.select("id", "unit_id").schema)
    assert empty.isEmpty()
    tables.write_table(rows.where("status_id = 4").select("id", "unit_id"), path, "append")
    wider = rows.where("status_id <> 4").select("id", "unit_id", F.col("price_nightly").alias("rate"))
    tables.write_table(wider, path, "append")
    return tables.read_evolved(spark, path)


@query(
    "reservations",
    """SELECT id, unit_id, CASE WHEN status_id <> 4 THEN price_nightly END AS rate FROM reservations""",
)
def catalog_table(spark, sf):
    """Catalog table created from a query, given a new column, and inserted to."""
    path = scratch_path(spark, "catalog")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = _small(spark, sf)
    old = rows.where("status_id = 4").select("id", "unit_id")
    tables.create_as(old, name, path)
    new = rows.where("status_id <> 4").select("id", "unit_id", F.col("price_nightly").alias("rate"))
    added = tables.add_missing_columns(spark, name, new.schema)
    assert added == ["rate"]
    new.write.insertInto(name)
    assert has_key(spark.table(name), ["id"])
    return spark.table(name)


@query(
    "reservations",
    """SELECT CAST(id AS VARCHAR) AS id, strftime(startdate, '%d/%m/%Y') AS startdate,
           CASE WHEN status_id <> 8 THEN strftime(enddate, '%d/%m/%Y') ELSE '' END AS enddate, type_name
    FROM reservations WHERE startdate >= DATE '1998-06-15'""",
)
def export_text(spark, sf):
    """Text export with formatted dates, from today on, read back."""
    path = scratch_path(spark, "export")
    rows = V.bookings(spark, sf).select(
        "id", "startdate", F.when(F.col("status_id") != 8, F.col("enddate")).alias("enddate"), "type_name"
    )
    export.export_text(rows, path, ["startdate", "enddate"], V.AS_OF)
    text = spark.read.csv(path, header=True, inferSchema=False, emptyValue="")
    return text.select(*[F.coalesce(c, F.lit("")).alias(c) for c in text.columns])


@query(
    "reservations",
    """SELECT CAST(id AS VARCHAR) AS id, strftime(startdate, '%d/%m/%Y') AS startdate,
           CASE WHEN status_id <> 8 THEN strftime(enddate, '%d/%m/%Y') ELSE '' END AS enddate, type_name
    FROM reservations""",
)
def export_text_all(spark, sf):
    """The same export of all bookings."""
    path = scratch_path(spark, "export")
    rows = V.bookings(spark, sf).select(
        "id", "startdate", F.when(F.col("status_id") != 8, F.col("enddate")).alias("enddate"), "type_name"
    )
    export.export_text(rows, path, ["startdate", "enddate"])
    text = spark.read.csv(path, header=True, inferSchema=False, emptyValue="")
    return text.select(*[F.coalesce(c, F.lit("")).alias(c) for c in text.columns])


@query(
    "units",
    """SELECT id, manager, balance FROM units""",
)
def sheet_from_csv(spark, sf):
    """Published sheet: landed CSV with a declared schema."""
    path = scratch_path(spark, "sheet")
    V.units(spark, sf).select("id", "manager", "balance").write.csv(path, header=True)
    schema = V.units(spark, sf).select("id", "manager", "balance").schema
    return sheets.read_sheet(spark, path, schema)


@query(
    "reservations",
    "SELECT id, unit_id FROM reservations WHERE status_id = 5 AND startdate >= DATE '1998-06-15'",
)
def pruned_scan(spark, sf):
    """Stored table read with its columns and predicate at the scan."""
    path = scratch_path(spark, "stored")
    tables.write_table(_small(spark, sf), path)
    wanted = (F.col("status_id") == 5) & (F.col("startdate") >= F.lit(V.AS_OF))
    return read_table(spark, path, ["id", "unit_id"], wanted)


@query(
    "units",
    """SELECT CAST(id AS VARCHAR) AS id, name, manager FROM units WHERE balance >= 0""",
)
def landed_documents(spark, sf):
    """Landed response files, one per manager, to rows."""
    path = scratch_path(spark, "landed")
    rows = V.units(spark, sf)
    body = F.when(
        F.col("balance") >= 0,
        F.to_json(
            F.struct(
                F.struct(F.array(F.struct(F.col("id").cast("string").alias("id"), "name")).alias("property")).alias("data"),
                F.col("manager"),
            )
        ),
    ).otherwise('{"status": {"code": "E0013"}}')
    # JSON lines here: a response per line instead of a file per response
    rows.select(body.alias("value")).write.text(path)
    docs = spark.read.text(path).select(F.col("value").alias("body"))
    shape = f"{schemas.PROPERTIES_DOC}, manager string"
    good, _ = split_documents(docs, "body", shape, "$.data.property")
    return good.select(F.inline("doc.data.property"), F.col("doc.manager").alias("manager")).select(
        "id", "name", "manager"
    )


@query(
    "reservations",
    """SELECT manager, count(*) AS reservations, count(*) + count(*) FILTER (status_id = 8) AS records,
           count(*) FILTER (status_id = 8) AS repeated
    FROM reservations GROUP BY manager""",
)
def landed_pages(spark, sf):
    """All response files written and read back, pages unwrapped by their number:
    reservations, the records they came in, and those that came again."""
    path = scratch_path(spark, "pages")
    _pages(spark, sf).select(F.to_json(F.struct("page", "body")).alias("value")).write.text(path)
    landed = spark.read.text(path).select(F.from_json("value", "page bigint, body string").alias("p"))
    records = documents.page_reservations(landed.select("p.*"), "body", "page")
    managers = V.units(spark, sf).select(F.col("id").cast("string").alias("unit_id"), "manager")
    per_id = records.groupBy("id", "unit_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.join(managers, "unit_id").groupBy("manager").agg(
        F.count(F.lit(1)).alias("reservations"), F.sum("n").alias("records"), F.count_if(F.col("n") > 1).alias("repeated")
    )


@query(
    "",
    """SELECT l_orderkey AS reservation_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS price,
           l_returnflag AS season, 'main office' AS manager
    FROM lineitem""",
)
def price_days_stream(spark, sf):
    """Landed price documents streamed into a table in two runs; files already
    taken are not taken again."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "prices", "offsets"))
    items = V.table(spark, sf, "lineitem").repartition("l_orderkey", "l_partkey")
    day = F.struct(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("season"),
    )
    doc = F.struct(F.col("l_orderkey").alias("reservation_id"), F.array(day).alias("reservation_days"))
    lines = items.select("l_linestatus", F.to_json(F.struct(doc.alias("data"))).alias("value"))
    for status in ("F", "O"):
        lines.where(F.col("l_linestatus") == status).select("value").write.mode("append").text(landing)
        docs = stream_documents(spark, landing, whole_files=False)
        append_price_days(docs, F.lit("main office"), table, checkpoint).awaitTermination()
    return spark.read.parquet(table).select("reservation_id", "date", "price", "season", "manager")


@query(
    "",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS __col_3,
           CASE WHEN c_acctbal > 0 THEN 'paid' ELSE '' END AS name_2
    FROM customer""",
)
def reference_sheets(spark, sf):
    """Sheets replacing their tables; an empty sheet keeps the old one."""
    root = scratch_path(spark, "sheets")
    grid = _grid(spark, sf)
    header = grid.where("row_no = 1")
    first = load_sheets({"targets": grid}, root)
    second = load_sheets({"targets": header, "empty": header.where("false")}, root)
    assert (first, second) == ({"targets": True}, {"targets": False, "empty": False})
    return publish.read_published(spark, f"{root}/targets")
