import datetime as dt

import pytest
from pyspark.sql import functions as F

from innkeep.operators import quality as Q
from innkeep.plans import operations as O

BOARD = "reservation string, unit string, check_in_date date, check_out_date date, next_arrival date, cleaning_date date"


def table(spark, n, price=10.0):
    return spark.range(n).select("id", F.lit(price).alias("price_nightly"))


@pytest.mark.parametrize(
    "base, new, passed",
    [(100, 105, True), (100, 106, False), (100, 99, False), (0, 0, True), (0, 1, False)],
)
def test_row_limits(spark, base, new, passed):
    gate = Q.quality_gate(table(spark, new), table(spark, base), "price_nightly")
    assert Q.gate_passed(gate) is passed


@pytest.mark.parametrize("price, passed", [(11.0, True), (9.0, True), (11.01, False), (8.99, False)])
def test_sum_limits(spark, price, passed):
    gate = Q.quality_gate(table(spark, 100, price), table(spark, 100), "price_nightly")
    assert Q.gate_passed(gate) is passed


def test_zero_baseline_sum(spark):
    zero = table(spark, 10, 0.0)
    assert Q.gate_passed(Q.quality_gate(zero, zero, "price_nightly"))
    assert not Q.gate_passed(Q.quality_gate(table(spark, 10), zero, "price_nightly"))


def test_missing_price_column_counts_as_zero(spark):
    ids = spark.range(5)
    assert Q.gate_passed(Q.quality_gate(ids, ids, "price_nightly"))


def test_other_columns_fail(spark):
    base = table(spark, 5)
    row = Q.quality_gate(base.withColumn("x", F.lit(1)), base, "price_nightly").first()
    assert (row.columns_ok, row.rows_ok, row.sum_ok, row.passed) == (False, True, True, False)


def test_bootstrap_lets_the_first_load_in(spark):
    gate = Q.quality_gate(table(spark, 5), table(spark, 0), "price_nightly", bootstrap=True)
    assert Q.gate_passed(gate)


def test_gate_reads_each_side_once(spark, tmp_path):
    for name in ("new", "base"):
        table(spark, 10).write.parquet(str(tmp_path / name))
    new, base = (spark.read.parquet(str(tmp_path / n)) for n in ("new", "base"))
    gate = Q.quality_gate(new, base, "price_nightly")
    plan = gate._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, t string")
    assert rows(Q.duplicate_keys(df, ["k", "t"])) == [(1, "a", 2)]


def test_profile(spark):
    df = spark.sql(
        "select 1 as i, 'é' || repeat('x', 300) as t, cast(null as string) as n, true as b, date'2025-01-01' as d, "
        "1.5D as f, cast(1 as decimal(18,2)) as m, timestamp_ntz'2025-01-01 00:00:00' as w"
    )
    got = {r.column_name: r for r in Q.column_profile(df).collect()}
    assert {c: r.storage_type for c, r in got.items()} == {
        "i": "BIGINT", "t": "VARCHAR(1024)", "n": "VARCHAR(255)", "b": "TINYINT(1)", "d": "DATE",
        "f": "DOUBLE", "m": "DECIMAL(18,2)", "w": "DATETIME",
    }
    assert (got["t"].max_length, got["n"].n_nulls, got["n"].max_length) == (301, 1, 0)


def day(n):
    return dt.date(1998, 6, n) if n else None


def board(spark, *rows):
    return spark.createDataFrame([(r, u, *map(day, days)) for r, u, *days in rows], BOARD)


def test_changes(spark, as_of):
    previous = board(
        spark,
        ("1.0", "A", 1, 20, 25, 20),
        ("2", "A", 1, 20, 25, 20),
        ("3", "A", 1, 20, 25, 20),
        ("4", "A", 1, 20, 25, 14),
        ("5", "A", 1, 20, 25, 15),
        ("6", "A", 1, 20, 25, 16),
        ("", "A", 1, 20, 25, 20),
        ("8", "A", 1, 20, None, 20),
        ("9", "A", 1, 20, 25, 10),
    )
    current = board(
        spark,
        ("1", "B", 2, 20, 25, 20),
        ("2", "A", 3, 21, 25, 20),
        ("3", "A", 1, 20, 25, 20),
        ("4", "A", 1, 20, 26, 14),
        (" ", "Z", 1, 20, 25, 20),
        ("7", "A", 1, 20, 25, 20),
        ("8", "A", 1, 20, 26, 20),
        ("9", "A", 1, 20, 25, 15),
    )
    got = {r.reservation: r for r in O.housekeeping_changes(current, previous, as_of).collect()}
    assert {k: r.change for k, r in got.items()} == {
        "1": "changed", "6": "cancelled", "8": "changed", "9": "changed",
    }
    assert got["1"].message == (
        "Reserva #1 foi alterada.\n  Alterações: Check-In Date: de 1998-06-01 para 1998-06-02; Unit: de 'A' para 'B'"
    )
    assert got["8"].message.endswith("Next Arrival: de 1970-01-01 para 1998-06-26")
    assert got["6"].message == (
        "Reserva #6 foi cancelada e excluída, pois não consta no arquivo atual. (Cleaning Date: 1998-06-16, Unit: 'A')"
    )
    assert got["6"].check_in_date_current is None and got["6"].check_in_date_previous == day(1)


def test_nothing_changes_against_itself(spark, as_of):
    same = board(spark, ("1", "A", 1, 20, 25, 20), ("2", None, 1, None, None, 20))
    assert O.housekeeping_changes(same, same, as_of).isEmpty()


def test_missing_and_blank_unit_are_the_same(spark, as_of):
    missing, blank = board(spark, ("1", None, 1, 20, 25, 20)), board(spark, ("1", "", 1, 20, 25, 20))
    assert O.housekeeping_changes(missing, blank, as_of).isEmpty()


def test_empty_boards(spark, as_of):
    some, none = board(spark, ("1", "A", 1, 20, 25, 20)), board(spark)
    assert O.housekeeping_changes(none, none, as_of).isEmpty()
    assert O.housekeeping_changes(some, none, as_of).isEmpty()
    assert O.housekeeping_changes(none, some, as_of).first().change == "cancelled"


def test_board_survives_its_sheet(spark, as_of, rows):
    before = board(spark, ("1.0", "A", 1, 20, None, 20))
    sheet = O.board_to_sheet(before)
    assert sheet.columns[:2] == ["Reservation #", "Unit"]
    grid = [(0, [*sheet.columns, "Extra"]), (1, [*sheet.first(), "x"]), (2, ["2", "B", "soon"])]
    back = O.board_from_sheet(spark.createDataFrame(grid, "row_no int, cells array<string>"))
    assert back.columns == before.columns
    assert rows(back) == [("1.0", "A", day(1), day(20), None, day(20)), ("2", "B", None, None, None, None)]
    assert O.board_from_sheet(spark.createDataFrame([], "row_no int, cells array<string>")) is None


def test_changes_use_joins_that_split_a_hot_key(spark, as_of):
    some = board(spark, ("1", "A", 1, 20, 25, 20))
    plan = O.housekeeping_changes(some, some, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "Inner" in plan and "LeftAnti" in plan


def test_units_to_register(spark, rows):
    a = spark.createDataFrame([("A",), ("A",), ("B",)], "unit string")
    b = spark.createDataFrame([("A",), ("C",)], "unit string")
    assert rows(O.units_to_register(a, b)) == [("A",)]


def test_work_orders(spark, rows):
    df = spark.createDataFrame(
        [
            ("U1", "Fix\r\n pump (Pool) ", "01/02/2025 10:00:00 EST", "07", "ann", "open"),
            ("U1", "Fix\r\n pump (Pool) ", "01/02/2025 10:00:00 EST", "07", "ann", "open"),
            ("U1", "Weekly CHECKLIST", "01/02/2025 10:00:00", "8", "ann", "open"),
            (" ", "x", "01/02/2025 10:00:00", "9", "ann", "open"),
            (None, "x", "01/02/2025 10:00:00", "10", "ann", "open"),
            ("U2", "x (other)", "later", "11", "bob", None),
            ("U3", "known", "01/02/2025 10:00:00", "12", "bob", "open"),
        ],
        "unit_name string, title string, creation_date string, id string, processor_name string, status_name string",
    )
    known = spark.createDataFrame([(12,)], "id int")
    got = O.work_order_triage(df, known, ["checklist"], {"pool": "POOL"}, [(["bob"], "GUEST")])
    assert rows(got) == [
        ("U1", "Fix pump (Pool)", "POOL", "2025-01-02 10:00:00", "7", "ann", "open"),
        ("U2", "x (other)", "GUEST", "", "11", "bob", ""),
    ]


def test_arrivals(spark, as_of):
    reservations = spark.createDataFrame(
        [(1, as_of, 4, 4), (2, as_of, 8, 4), (3, as_of, None, 4), (-4, as_of, 4, 4), (5, dt.date(1998, 6, 16), 4, 4), (6, as_of, 4, 4)],
        "confirmation_id bigint, startdate date, status_code int, status_id int",
    )
    body = (
        '{"data": {"reservation": {"confirmation_id": "%d", "startdate": "06/15/1998", "unit_name": "U", "first_name": null, '
        '"last_name": "Doe", "additional_fields": {"additional_field": [{"name": "Code", "value": "1"}, {"name": "Code", "value": "%s"}]}}}}'
    )
    docs = spark.createDataFrame(
        [(1, body % (1, "1234")), (2, body % (2, "1")), (3, body % (3, "1")), (5, body % (5, "1")), (6, body % (6, "abc"))],
        "confirmation_id bigint, body string",
    )
    sheet = O.by_arrival(O.arrivals_sheet(reservations, docs, as_of, "Code", "A", "B")).collect()
    assert sorted((r.client_name, r.door_code, r.emergency_code, r.phone) for r in sheet) == [
        ("Doe", "1234#", "A", None), ("Doe", "6", "B", None),
    ]
    nobody = O.arrivals_sheet(reservations.where("confirmation_id > 99"), docs, as_of, "Code", "A", "B")
    assert nobody.isEmpty()
