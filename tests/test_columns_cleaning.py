import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from innkeep.operators import cleaning as C, columns as P
from innkeep.sources import sheets


def test_clean_names():
    names = [" a b", "a.b", "a-b", "x(1)", "x[1]", "nan", "", "y" * 70, "y" * 65]
    assert P.clean_names(names) == [
        "a_b", "a_b_1", "a_b_2", "x1", "x1_1", None, None, "y" * 64, "y" * 62 + "_1",
    ]


@given(st.lists(st.text(alphabet="ab .-()[]", min_size=1, max_size=6), max_size=8))
@settings(max_examples=50, deadline=None)
def test_clean_names_are_plain_and_short(names):
    cleaned = P.clean_names(names, max_len=5)
    assert len(cleaned) == len(names)
    assert all(len(c) <= 5 and not set(c) & set(" .-()[]") for c in cleaned)


def test_clean_columns_takes_repeated_names(spark):
    df = spark.sql("select 1 as `a b`, 2 as `a.b`, 3 as `nan`, 4 as `a b`")
    assert P.clean_columns(df).columns == ["a_b", "a_b_1", "a_b_2"]
    assert tuple(P.clean_columns(df).first()) == (1, 2, 4)


def test_conform_adds_orders_and_casts(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([("x", "1"), ("y", "bad")], "extra string, n string")
    assert [tuple(r) for r in P.conform(df, schema).collect()] == [(1, None), (None, None)]


def test_map_and_keep(spark):
    df = spark.sql("select 1 as a, 2 as b")
    assert tuple(P.map_columns(df, {"x": "b", "y": None, "z": "nope"}).first()) == (2, "", "")
    assert P.keep_present(df, ["b", "nope", "a"]).columns == ["b", "a"]


def test_drop_clashing_ignores_case(spark):
    left, right = spark.sql("select 1 as Date, 2 as id"), spark.sql("select 3 as date, 4 as ID, 5 as price")
    assert P.drop_clashing(right, left).columns == ["price"]
    assert P.drop_clashing(right, left, keep=["id"]).columns == ["ID", "price"]


def test_suffixed_and_same_columns(spark):
    df = spark.sql("select 1 as a, 2 as b")
    assert P.suffixed(df, "_current", ["b"]).columns == ["a", "b_current"]
    assert P.same_columns(df, df.select("b", "a")) and not P.same_columns(df, df.select("a"))


def test_null_tokens(spark, rows):
    df = spark.createDataFrame(
        [("nan", 1.0), ("NaN", float("nan")), ("None", 2.0), ("", None), ("ok", 3.0)], "t string, v double"
    )
    got = [tuple(r) for r in C.null_tokens(df).collect()]
    assert got == [(None, 1.0), (None, None), (None, 2.0), (None, None), ("ok", 3.0)]
    assert C.nan_to_null(df).where("v is null").count() == 2
    assert C.nan_to_null(df).where("t is null").count() == 0


def test_remap_is_one_step_and_keeps_others(spark, rows):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, None)], "id int, unit int")
    lookup = spark.createDataFrame([(1, 2), (2, 3)], "from_id int, to_id int")
    assert rows(C.remap(df, "unit", lookup), "id", "unit") == [(1, 2), (2, 3), (3, 9), (4, None)]


def test_patch(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    fixes = spark.createDataFrame([(2, "z"), (7, "q")], "id int, t string")
    assert rows(C.patch(df, "id", "t", fixes), "id", "t") == [(1, "a"), (2, "z")]


def test_set_where_in(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x")], "u string, s string")
    assert rows(C.set_where_in(df, "u", ["a"], "s", "y"), "u", "s") == [("a", "y"), ("b", "x"), (None, "x")]
    assert C.set_where_in(df, "u", [], "s", "y") is df


def test_nested_to_json(spark):
    df = spark.sql("select array(1, 2) as a, named_struct('x', 'é') as s, map('k', 1) as m, 5 as n")
    assert tuple(C.nested_to_json(df).first()) == ("[1,2]", '{"x":"é"}', '{"k":1}', 5)


def test_cast_if_all_parse_is_all_or_nothing(spark):
    df = spark.createDataFrame([("2025-01-02", "2025-01-02"), (None, "soon")], "a string, b string")
    got = C.cast_if_all_parse(df, ["a", "b"])
    assert got.schema["a"].dataType == T.DateType() and got.schema["b"].dataType == T.StringType()
    assert got.first().a == dt.date(2025, 1, 2)


def test_unparsed_report(spark):
    df = spark.createDataFrame([("1/1/2025",), ("zz",), ("aa",), (None,)], "raw string")
    report = C.unparsed_report(df, {"raw": F.try_to_date("raw", "M/d/yyyy")}).first()
    assert tuple(report) == ("raw", 2, "aa", "zz")


def test_header_repair():
    assert sheets.repair_header([" a ", "", None, "a", "a"]) == ["a", "__col_2", "__col_3", "a_2", "a_3"]


def test_grid(spark, rows):
    schema = "row_no int, cells array<string>"
    grid = spark.createDataFrame(
        [(1, ["id", "", "id"]), (2, ["1"]), (3, ["1", "2", "3", "4"]), (4, None), (5, [])], schema
    )
    table = sheets.read_grid(grid)
    assert table.columns == ["row_no", "id", "__col_2", "id_2"]
    assert rows(table) == [(2, "1", "", ""), (3, "1", "2", "3"), (4, "", "", ""), (5, "", "", "")]
    assert sheets.read_grid(spark.createDataFrame([], schema)) is None
    only_header = sheets.read_grid(grid.where("row_no = 1"))
    assert only_header.columns == ["row_no", "id", "__col_2", "id_2"] and only_header.isEmpty()
    assert rows(sheets.grid_ids(grid, 0)) == [("1",), ("id",)]
