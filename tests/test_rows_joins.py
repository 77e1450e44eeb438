import datetime as dt

from pyspark.sql import functions as F

from innkeep.operators import joins as J, numbering, rows as R


def test_not_in_drops_null(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(df.where(R.not_in("a", [1]))) == [(2,)]
    assert df.where(R.not_in("a", [])).count() == 3


def test_overlaps_is_closed(spark, rows):
    df = spark.sql(
        "select * from values (1, date'1998-01-01', date'1998-01-10'), (2, date'1998-01-20', date'1998-01-30'), "
        "(3, date'1998-01-11', date'1998-01-19') as t(id, s, e)"
    )
    assert rows(df.where(R.overlaps("s", "e", dt.date(1998, 1, 10), dt.date(1998, 1, 20))), "id") == [(1,), (2,), (3,)]
    assert rows(df.where(R.overlaps("s", "e", dt.date(1998, 1, 12), dt.date(1998, 1, 13))), "id") == [(3,)]


def test_latest_row_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, "c")], "k int, t int, v string")
    assert rows(R.latest_row(df, ["k"], "t", ["v"])) == [(1, 5, "b"), (2, 1, "c")]
    assert rows(R.first_by(df, ["k"], ["t", "v"])) == [(1, 4, "z"), (2, 1, "c")]


def test_latest_snapshot_keeps_the_whole_load(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, "c")], "k int, t int, v string")
    assert rows(R.latest_snapshot(df, ["k"], "t")) == [(1, 5, "a"), (1, 5, "b"), (2, 1, "c")]


def test_pending_and_sets(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    b = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    assert rows(R.pending(a, b, ["id"])) == [(1,), (3,)]
    assert rows(R.only_keys(a, b, ["id"])) == [(2,), (2,)]
    assert rows(R.in_both(a, b)) == [(2,)]
    assert rows(R.not_in_other(a, b, ["id"])) == [(1,), (3,)]
    assert rows(R.union_distinct([a, b])) == [(1,), (2,), (3,), (9,)]
    assert R.next_pending(a, b, ["id"], 1, ["id"]).collect()[0].id == 1


def test_lookup_keeps_unmatched_and_ignores_case(spark, rows):
    df = spark.createDataFrame([(1, "Main "), (2, "other"), (None, "main")], "unit int, manager string")
    dim = spark.createDataFrame([(1, "MAIN", "x"), (None, "main", "y")], "id int, manager string, name string")
    got = J.lookup(df, dim, {"unit": "id", "manager": "manager"}, {"label": "name"}, ("manager",))
    assert rows(got) == [(1, "Main ", "x"), (2, "other", None), (None, "main", None)]


def test_left_details(spark, rows):
    heads = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    detail = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (7, 1, "d")], "rid int, load int, v string")
    assert rows(J.left_details(heads, detail, {"id": "rid"}, {"v": "v"})) == [
        (1, "a"), (1, "b"), (1, "c"), (2, None), (None, None),
    ]
    latest = J.left_details(heads, detail, {"id": "rid"}, {"v": "v", "load": "load"}, latest="load")
    assert rows(latest, "id", "v", "load") == [(1, "b", 2), (1, "c", 2), (2, None, None), (None, None, None)]


def test_detail_without_load_time_is_not_lost_for_all_loads(spark, rows):
    heads = spark.createDataFrame([(1,)], "id int")
    detail = spark.createDataFrame([(1, None, "a")], "rid int, load int, v string")
    assert rows(J.left_details(heads, detail, {"id": "rid"}, {"v": "v"})) == [(1, "a")]


def test_hot_key_detail_join_equals_brute_force(spark):
    """A third of the detail rows belongs to one head."""
    heads = spark.range(200).select(F.col("id"))
    hot = F.col("id") < 20_000
    detail = spark.range(60_000).select(
        F.when(hot, 7).otherwise(F.col("id") % 250).alias("rid"),
        F.when(hot, 2).otherwise(F.col("id") % 3).alias("load"),
        F.col("id").alias("v"),
    )
    settings = {
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = J.left_details(heads, detail, {"id": "rid"}, {"v": "v"}, latest="load")
        pairs = sorted((r.id, r.v) for r in got.collect() if r.v is not None)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    loads = {}
    for i in range(60_000):
        rid, load = (7, 2) if i < 20_000 else (i % 250, i % 3)
        loads.setdefault(rid, []).append((load, i))
    want = []
    for rid, rows in loads.items():
        newest = max(rows)[0]
        want += [(rid, i) for load, i in rows if rid < 200 and load == newest]
    want.sort()
    assert pairs == want
    assert "skew=true" in plan


def test_first_sale(spark, rows):
    df = spark.sql(
        "select * from values (1, 'm', date'1998-01-02', date'1998-02-01'), (1, 'm', date'1998-01-01', date'1998-03-01'), "
        "(1, 'm', null, date'1990-01-01'), (2, 'm', null, date'1990-01-01') as t(u, m, b, d)"
    )
    assert rows(R.first_sale(df, ["u", "m"], "b", "d")) == [
        (1, "m", dt.date(1998, 1, 1), dt.date(1998, 3, 1), dt.date(1998, 2, 1))
    ]


def test_join_ordered(spark, rows):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "c")], "k int, p int, t string")
    assert rows(R.join_ordered(df, ["k"], "t", ["p"], "out")) == [(1, "a, b"), (2, "c")]


def test_join_ordered_in_parts(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, 1, "d"), (1, 1, 2, "b"), (1, 1, 1, "a"), (1, 2, 0, "c"), (1, 3, 0, None), (2, 1, 1, None)],
        "k int, p int, q int, t string",
    )
    assert rows(R.join_ordered(df, ["k"], "t", ["p", "q"], "out")) == [(1, "a, b, c, d"), (2, None)]


def test_numbering_is_gap_free_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("t"))
    numbered = numbering.number_rows(df, ["v"], start=5)
    got = sorted((r.v, r.row_no) for r in numbered.collect())
    assert got == [(v, v + 5) for v in range(1000)]


def test_number_after_skips_blank_tail(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, " "), (4, None)], "row_no int, t string")
    new = spark.createDataFrame([("y",), ("x",)], "v string")
    assert rows(numbering.number_after(new, target, "row_no", "t", ["v"]), "v", "row_no") == [("x", 3), ("y", 4)]
    assert rows(numbering.number_after(new, target.where("false"), "row_no", "t", ["v"]), "row_no") == [(1,), (2,)]
    assert numbering.number_after(new.where("false"), target, "row_no", "t", ["v"]).isEmpty()


def copies(spark):
    """A third of the rows are copies of one row."""
    return spark.range(9000).select(
        F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 3).alias("t"),
    )


def test_hot_copies_in_sets(spark, rows):
    df = copies(spark)
    want = {(7, 1)} | {(i % 500, i % 3) for i in range(3000, 9000)}
    assert rows(R.union_distinct([df, df])) == sorted(want, key=repr)
    other = df.where("k < 10")
    assert rows(R.in_both(df, other)) == sorted((w for w in want if w[0] < 10), key=repr)
    assert R.pending(df, other, ["k"]).count() == sum(1 for i in range(3000, 9000) if i % 500 >= 10)
    plan = R.in_both(df, other)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below


def test_hot_key_first_row(spark, rows):
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )
    first = {7: 0}
    for i in range(3000, 9000):
        first[i % 500] = min(first.get(i % 500, i), i)
    assert rows(R.first_by(df, ["k"], ["v"])) == sorted(first.items(), key=repr)


def test_numbering_with_a_hot_order_value(spark):
    df = copies(spark).withColumn("id", F.monotonically_increasing_id())
    got = sorted((r.k, r.id, r.row_no) for r in numbering.number_rows(df, ["k", "id"]).collect())
    assert [n for _, _, n in got] == list(range(1, 9001))


def test_chained_lookups_on_a_hot_key(spark):
    """Both joins share a key, so splitting it takes one more shuffle."""
    hot = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, 7).otherwise(F.col("id") % 300).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(200).select(F.col("id"), (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"))
    settings = {
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        first = J.lookup(hot, dim, {"k": "id"}, {"a": "a"})
        got = J.lookup(first, dim, {"k": "id"}, {"b": "b"})
        found = sorted((r.v, r.k, r.a, r.b) for r in got.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    keys = [7 if i < 20_000 else i % 300 for i in range(60_000)]
    assert found == [(i, k, k * 2, k * 3) if k < 200 else (i, k, None, None) for i, k in enumerate(keys)]
    assert "skew=true" in plan
