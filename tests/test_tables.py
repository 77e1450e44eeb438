import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from innkeep.operators.quality import has_key, quality_gate
from innkeep.session import durable, scratch_path, shared_dir, stored
from innkeep.sinks import export, publish, snapshots, tables
from innkeep.sources import sheets
from innkeep.plans.sheets import reference_sheets
from innkeep.sources.tables import counts_for_day, read_table
from innkeep.streaming.landing import append_price_days, stream_documents

DAY1, DAY2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "t")


def nums(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_publish_swaps_and_keeps_on_empty(spark, root, rows):
    assert publish.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    assert not publish.publish(nums(spark), root)
    assert publish.current_version(spark, root) is None
    for version, values in enumerate([(1,), (2, 3), (4,)], start=1):
        assert publish.publish(nums(spark, *values), root)
        assert publish.current_version(spark, root)[0] == version
        assert rows(publish.read_published(spark, root)) == [(v,) for v in values]
    assert not publish.publish(nums(spark), root)
    assert rows(publish.read_published(spark, root)) == [(4,)]


def test_reader_outlives_further_publishes(spark, root, rows):
    publish.publish(nums(spark, 1), root)
    reader = publish.read_published(spark, root)
    for value in (2, 3, 4):
        publish.publish(nums(spark, value), root)
    assert rows(reader) == [(1,)] and rows(publish.read_published(spark, root)) == [(4,)]


def test_old_versions_go(spark, root):
    for value in (1, 2, 3):
        publish.publish(nums(spark, value), root, keep=1)
    assert len(os.listdir(root + "/data")) == 1


def test_published_table_can_feed_its_own_next_version(spark, root, rows):
    publish.publish(nums(spark, 1), root)
    publish.publish(publish.read_published(spark, root).union(nums(spark, 2)), root)
    assert rows(publish.read_published(spark, root)) == [(1,), (2,)]


def test_gate_guards_publish(spark, root, rows):
    base, same, double = nums(spark, 1, 2), nums(spark, 3, 4), nums(spark, 1, 2, 3, 4)
    publish.publish(base, root)
    assert not publish.publish_if(quality_gate(double, base, "price"), double, root)
    assert rows(publish.read_published(spark, root)) == [(1,), (2,)]
    assert publish.publish_if(quality_gate(same, base, "price"), same, root)
    assert rows(publish.read_published(spark, root)) == [(3,), (4,)]


def test_log(spark, root):
    gate = quality_gate(nums(spark, 1), nums(spark, 1), "price")
    for hour in (1, 2):
        tables.log_check(gate, root, "reservations", "job", dt.datetime(2025, 1, 1, hour))
    log = spark.read.parquet(root).orderBy("run_at").collect()
    assert [(r.table_name, r.status, r.run_at.hour) for r in log] == [("reservations", 1, 1), ("reservations", 1, 2)]


def test_snapshot_of_a_day_is_idempotent(spark, root, rows):
    snapshots.snapshot_replace(nums(spark, 1, 2), root, DAY1)
    for _ in range(2):
        snapshots.snapshot_replace(nums(spark, 3), root, DAY2)
    snapshots.snapshot_replace(nums(spark), root, DAY2)
    assert rows(spark.read.parquet(root)) == [(1, DAY1), (2, DAY1), (3, DAY2)]


def test_snapshot_if_absent(spark, root, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, t string")
    assert snapshots.snapshot_if_absent(df, root, DAY1, ["id"], ["t"])
    assert not snapshots.snapshot_if_absent(df, root, DAY1, ["id"], ["t"])
    assert snapshots.snapshot_if_absent(df.where("id = 2"), root, DAY2, ["id"], ["t"])
    assert rows(spark.read.parquet(root)) == [(1, "a", DAY1), (2, "c", DAY1), (2, "c", DAY2)]


def test_history_and_current(spark, root, rows):
    for load, *values in (("a", 9), ("a", 1), ("b", 2)):  # the first load is run again
        tables.write_history_and_current(nums(spark, *values), root + "h", root + "c", load)
    assert rows(spark.read.parquet(root + "h")) == [(1, "a"), (2, "b")]
    assert rows(spark.read.parquet(root + "c")) == [(2,)]


def test_ensure_like_creates_once(spark, root, rows):
    schema = nums(spark).schema
    assert tables.ensure_like(spark, root, schema).isEmpty()
    tables.write_table(nums(spark, 5), root, "append")
    assert rows(tables.ensure_like(spark, root, schema)) == [(5,)]
    tables.write_table(nums(spark, 6).withColumn("rate", F.lit(1.5)), root, "append")
    assert rows(tables.read_evolved(spark, root)) == [(5, None), (6, 1.5)]


def test_catalog_table(spark, root, rows):
    tables.create_as(nums(spark, 1), "kept_numbers", root)
    try:
        wider = nums(spark, 2).withColumn("rate", F.lit(1.5))
        assert tables.add_missing_columns(spark, "kept_numbers", wider.schema) == ["rate"]
        assert tables.add_missing_columns(spark, "kept_numbers", wider.schema) == []
        wider.write.insertInto("kept_numbers")
        assert rows(spark.table("kept_numbers")) == [(1, None), (2, 1.5)]
        tables.create_as(nums(spark, 3), "kept_numbers", root)
        assert rows(spark.table("kept_numbers")) == [(3,)]
    finally:
        spark.sql("DROP TABLE kept_numbers")


def test_key(spark):
    assert has_key(nums(spark, 1, 2), ["id"])
    assert not has_key(nums(spark, 1, 1), ["id"])
    assert not has_key(nums(spark, 1, None), ["id"])


def test_export(spark, root):
    df = spark.createDataFrame([(1, DAY1, None), (2, DAY2, DAY2)], "id int, a date, b date")
    export.export_text(df, root, ["a", "b"], as_of=DAY1, as_of_col="a")
    got = spark.read.csv(root, header=True).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in got] == [("1", "01/01/2025", None), ("2", "02/01/2025", "02/01/2025")]
    assert export.from_day(df, "a", DAY2).count() == 1
    assert tuple(export.as_text(df, ["a"]).orderBy("id").first()) == ("1", "01/01/2025", "")


def test_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name\n1,a\nx,b\n")
    schema = spark.createDataFrame([], "id int, name string").schema
    assert [tuple(r) for r in sheets.read_sheet(spark, str(tmp_path), schema).collect()] == [(1, "a"), (None, "b")]


def test_scan_is_pruned_and_filtered(spark, root):
    spark.range(10).select("id", (F.col("id") * 2).alias("v"), F.lit("x").alias("t")).write.parquet(root)
    df = read_table(spark, root, ["v"], "id > 5")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,v:bigint>" in plan
    assert df.count() == 4


def test_day_count(spark):
    df = spark.createDataFrame([(DAY1,), (DAY1,), (DAY2,)], "d date")
    assert tuple(counts_for_day(df, "d", str(DAY1)).first()) == (3, 2)


def test_shared_folder_comes_from_the_session(spark):
    shared = shared_dir(spark)
    assert shared == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x").startswith(shared.rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_durable_and_stored_hold_the_rows(spark, rows):
    df = nums(spark, 1, 2)
    assert rows(durable(df)) == rows(stored(df, "t")) == [(1,), (2,)]
    plan = durable(df.groupBy("id").count())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sheets_replace_tables_unless_empty(spark, root, rows):
    schema = "row_no int, cells array<string>"
    sheet = spark.createDataFrame([(1, ["id", "v"]), (2, ["1"])], schema)
    assert reference_sheets({"a": sheet}, root) == {"a": True}
    assert reference_sheets({"a": sheet.where("row_no = 1")}, root) == {"a": False}
    assert rows(publish.read_published(spark, root + "/a")) == [("1", "")]


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    landing, table, offsets = (str(tmp_path / n) for n in ("landing", "table", "offsets"))
    body = '{"data": {"reservation_id": %d,\n "reservation_days": [{"date": "13/04/2025", "price": "5"}]}}'
    (tmp_path / "landing").mkdir()
    for run in (1, 2):
        (tmp_path / "landing" / f"{run}.json").write_text(body % run)
        docs = stream_documents(spark, landing)
        append_price_days(docs, F.lit("m"), table, offsets).awaitTermination()
        got = spark.read.parquet(table)
        assert rows(got, "reservation_id", "date", "price") == [(n, dt.date(2025, 4, 13), 5.0) for n in range(1, run + 1)]
