import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from innkeep.plans import dimensions, unit_days
from innkeep.plans.reservations import reservations_by_date

D = dt.date
HOUSE = "id bigint, name string, location_name string, bedrooms_number bigint, bathrooms_number bigint, condo_type_name string, condo_type_group_name string, max_adults bigint, renting_type string, manager string"


def house(spark, *rows):
    return spark.createDataFrame(
        [(i, n, "loc", 1, 1, "t", "g", 2, kind, m) for i, n, kind, m in rows], HOUSE
    )


def bookings(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "id bigint, unit_id bigint, manager string, status_id int, type_name string, days_number int, creation_date date",
    )


def prices(spark, *rows):
    return spark.createDataFrame(list(rows), "reservation_id bigint, date date, price double, data_price date, manager string")


def test_house_dimension(spark, rows):
    current = house(spark, (1, "a", "RENTING", "m"), (2, "b", None, "m"))
    loads = [(1, "a", "RENTING", "m"), (3, "old", "RENTING", "m")]
    history = house(spark, *loads).withColumn("load_time", F.lit(D(2025, 1, 1))).unionByName(
        house(spark, (3, "new", "RENTING", "m"), (3, "newer", "RENTING", "m")).withColumn("load_time", F.lit(D(2025, 1, 2)))
    )
    booked = bookings(spark, (1, 1, "m", 4, "t", 1, None), (2, 9, "m", 4, "t", 1, None))
    got = dimensions.house_dimension(current, history, booked)
    assert rows(got, "id", "name", "renting_type") == [
        (1, "a", "RENTING"), (2, "b", "NON-RENTING"), (3, "newer", "NON-RENTING"), (9, None, "NON-RENTING"),
    ]


def test_renting_type_by_id_alone_repeats_rows(spark):
    current = house(spark, (1, "a", "RENTING", "m"), (1, "a", "OWNER", "n"))
    history, booked = current.withColumn("load_time", F.lit(D(2025, 1, 1))), bookings(spark)
    assert dimensions.house_dimension(current, history, booked).count() == 2
    assert dimensions.house_dimension(current, history, booked, match_manager=False).count() == 4


def test_by_date(spark, rows):
    res = bookings(spark, (1, 10, "m", 4, "t", 1, None), (2, 11, "m", 8, "t", 1, None), (3, 12, "m", 5, "t", 1, D(2025, 1, 1)))
    days = prices(
        spark,
        (1, D(2025, 1, 5), 10.0, D(2025, 1, 1), "x"),
        (1, D(2025, 1, 5), 12.0, D(2025, 1, 2), "x"),
        (1, D(2025, 1, 6), 13.0, D(2025, 1, 2), "x"),
        (9, D(2025, 1, 6), 13.0, D(2025, 1, 2), "x"),
    )
    mirrors = spark.createDataFrame([(10, 20)], "from_id bigint, to_id bigint")
    fixes = spark.createDataFrame([(3, D(2024, 1, 1))], "id bigint, creation_date date")
    got = reservations_by_date(res, days, mirrors, fixes)
    assert rows(got, "id", "unit_id", "date", "price", "manager", "creation_date") == [
        (1, 20, D(2025, 1, 5), 12.0, "m", None),
        (1, 20, D(2025, 1, 6), 13.0, "m", None),
        (3, 12, None, None, "m", D(2024, 1, 1)),
    ]
    assert reservations_by_date(res, days, mirrors, latest_only=False).count() == 4


def test_by_date_takes_text_statuses(spark, rows):
    res = bookings(spark, (1, 10, "m", 4, "t", 1, None), (2, 11, "m", 8, "t", 1, None), (3, 12, "m", 5, "t", 1, None))
    text = res.withColumn("status_id", F.when(F.col("id") == 3, "n/a").otherwise(F.col("status_id").cast("string")))
    none = spark.createDataFrame([], "from_id bigint, to_id bigint")
    assert rows(reservations_by_date(text, prices(spark, (1, D(2025, 1, 5), 1.0, D(2025, 1, 1), "x")), none), "id") == [(1,)]


def test_units_are_one_however_their_manager_is_spelled(spark, rows):
    listed = house(spark, (1, "a", "RENTING", "Casa São"))
    booked = bookings(spark, (1, 1, "CASA SÃO ", 4, "t", 1, None), (2, 1, "Casa Sao", 4, "t", 1, None), (3, 2, "b", 4, "t", 1, None))
    assert rows(dimensions.spine_units(listed, booked)) == [(1, "Casa São"), (2, "b")]


def test_first_sales_do_not_depend_on_the_window(spark):
    day = D(2025, 1, 2)
    data = inputs(spark, sales(spark))
    none = spark.createDataFrame([], "unit_id bigint")
    flags = spark.createDataFrame([], "id_unit bigint, value string")
    names = [spark.createDataFrame([], f"type_name string, {c} string") for c in ("status", "channel")]
    cal = dimensions.calendar(spark, D(2024, 1, 1), D(2025, 12, 31), None, day)
    got = unit_days.unit_day_sales(data, cal, *names, flags, none, D(2025, 1, 3), D(2025, 1, 3), day)
    assert [(r.first_booking, r.last_sold_day) for r in got.where("unit_id = 1").collect()] == [(D(2024, 10, 1), day)]


def inputs(spark, sales):
    rates = "id_unit bigint, manager string, date string, season string, rate double, min_stay int"
    return unit_days.Inputs(
        properties=house(spark, (1, "a", "RENTING", "M"), (2, "b", "OWNER", "M"), (5, "e", "RENTING", None)),
        reservations=bookings(spark, (1, 3, "M", 4, "t", 1, None)),
        sales=sales,
        target_rates=spark.createDataFrame([(1, "m ", "01/02/2025", "HIGH", 100.0, 2)], rates),
        prices=spark.createDataFrame([(3, "M", "2025-01-01", "LOW", 90.0, 1)], rates),
        seasons=spark.createDataFrame(
            [("m", D(2025, 1, 2), 0.9, "S", 1, "H", 2, "I")],
            "manager string, date date, occupancy double, season string, holiday_of_year int, holiday_name string, holiday_days int, season_interval string",
        ),
        houses=house(spark, (1, "a", "RENTING", "M"), (3, "c", None, "M")),
    )


SALES = "id bigint, unit_id bigint, manager string, date string, type_name string, days_number int, creation_date date, price double"


def sales(spark):
    return spark.createDataFrame(
        [
            (7, 1, "M", "01/02/2025", "Web", 4, D(2024, 10, 1), 50.0),
            (8, 1, "m", "01/02/2025", "Other", 20, D(2025, 1, 1), 60.0),
            (9, 3, "M", "02/03/2025", "Web", 2, None, 70.0),
            (10, 1, "M", None, "Web", 2, D(2020, 1, 1), 70.0),
            (11, 99, "M", "01/02/2025", "Web", 2, D(2020, 1, 1), 70.0),
            (12, 1, "N", "01/02/2025", "Web", 2, D(2020, 1, 1), 70.0),
        ],
        SALES,
    )


def test_unit_day_base(spark, rows):
    got = unit_days.unit_day_base(inputs(spark, sales(spark)), D(2025, 1, 1), D(2025, 1, 3))
    picked = rows(got, "unit_id", "date", "reservation", "target_rate", "current_rate", "season_name", "name")
    assert picked == sorted(
        [
            (1, D(2025, 1, 1), None, None, None, None, "a"),
            (1, D(2025, 1, 2), 7, 100.0, None, "S", "a"),
            (1, D(2025, 1, 2), 8, 100.0, None, "S", "a"),
            (1, D(2025, 1, 3), None, None, None, None, "a"),
            (3, D(2025, 1, 1), None, None, 90.0, None, "c"),
            (3, D(2025, 1, 2), None, None, None, "S", "c"),
            (3, D(2025, 1, 3), None, None, None, None, "c"),
            *[(5, D(2025, 1, d), None, None, None, None, None) for d in (1, 2, 3)],
        ],
        key=repr,
    )


def test_unit_day_sales(spark, rows):
    day = D(2025, 1, 2)
    cal = dimensions.calendar(spark, D(2024, 1, 1), D(2025, 12, 31), None, day)
    got = unit_days.unit_day_sales(
        inputs(spark, sales(spark)),
        cal,
        spark.createDataFrame([("WEB", "Sold")], "type_name string, status string"),
        spark.createDataFrame([("web ", "direct")], "type_name string, channel string"),
        spark.createDataFrame([(1, "SIM")], "id_unit bigint, value string"),
        spark.createDataFrame([(3,)], "unit_id bigint"),
        D(2025, 1, 1),
        D(2025, 1, 3),
        day,
    )
    assert got.where("unit_id = 3").isEmpty()
    one = {(r.date.day, r.reservation): r for r in got.where("unit_id = 1").collect()}
    assert set(one) == {(1, None), (2, 7), (2, 8), (3, None)}
    web, other, free = one[2, 7], one[2, 8], one[1, None]
    assert (web.sale_status, web.channel, web.lead_days, web.lead_band, web.stay_band) == (
        "Sold", "direct", 93, "<= 120 days", "<= 5 nigths",
    )
    assert (other.sale_status, other.channel, other.lead_order, other.stay_band) == (
        "Disponivel", None, "1", "Acima de 15 nigths",
    )
    assert (free.sale_status, free.lead_band, free.stay_band, free.is_future, free.in_target) == (
        "Disponivel", "-", "-", 0, "SIM",
    )
    assert {r.first_booking for r in one.values()} == {D(2024, 10, 1)}
    assert {(r.first_sold_day, r.last_sold_day) for r in one.values()} == {(day, day)}
    null_manager = got.where("unit_id = 5").collect()
    assert len(null_manager) == 3 and {r.first_booking for r in null_manager} == {None}


def test_hot_unit_day_equals_brute_force(spark):
    """A third of all sales falls on one unit and day."""
    many = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id") % 7).cast("bigint").alias("unit_id"),
        F.lit("M").alias("manager"),
        F.when(F.col("id") < 1000, "2025-01-02")
        .otherwise(F.concat(F.lit("2025-01-0"), (F.col("id") % 9 + 1).cast("string")))
        .alias("date"),
        F.lit("Web").alias("type_name"),
        F.lit(2).alias("days_number"),
        F.lit(D(2024, 12, 1)).alias("creation_date"),
        F.col("id").cast("double").alias("price"),
    )
    got = unit_days.unit_day_base(inputs(spark, many), D(2025, 1, 1), D(2025, 1, 5))
    have = sorted((r.unit_id, r.date.day, r.reservation if r.reservation is not None else -1) for r in got.collect())
    cells = {}
    for i in range(3000):
        unit, d = (1, 2) if i < 1000 else (i % 7, i % 9 + 1)
        cells.setdefault((unit, d), []).append(i)
    want = [
        (u, d, i)
        for u in (1, 3, 5)
        for d in range(1, 6)
        for i in (cells.get((u, d), [-1]) if u != 5 else [-1])
    ]
    assert have == sorted(want)


def test_free_days_are_not_shuffled(spark):
    """Only sales and days with a rate are dealt by day; units meet their free days as bit sets."""
    data = inputs(spark, sales(spark))
    start, end = D(2020, 1, 1), D(2026, 12, 30)
    got = unit_days.unit_day_base(data, start, end)
    assert got.count() == 3 * ((end - start).days + 1) + 1
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan()
    written = _shuffled_rows(plan)
    assert written and max(written) < 100


def _shuffled_rows(plan):
    """Rows that each exchange of a finished plan wrote."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_days_with_a_rate_beside_sold_and_free_ones(spark):
    """Rates and prices on sold days, on free days, outside the window and for units nobody knows."""
    rates = "id_unit bigint, manager string, date date, season string, rate double, min_stay int"
    asked = [(1, "M", D(2025, 1, 2), "a", 1.0, 1), (1, "M", D(2025, 1, 31), "b", 2.0, 1), (1, "M", D(2025, 2, 2), "b", 2.5, 1)]
    asked += [(1, "M", D(2025, 1, 30), "c", 3.0, 1), (9, "M", D(2025, 1, 30), "c", 3.0, 1), (5, None, D(2025, 1, 30), "c", 3.0, 1)]
    priced = [(1, "m", D(2025, 1, 31), "a", 4.0, 1), (1, "M", D(2025, 1, 31), "a", 5.0, 1), (3, "M", D(2025, 2, 1), "a", 6.0, 1)]
    data = replace(
        inputs(spark, sales(spark)),
        target_rates=spark.createDataFrame(asked, rates),
        prices=spark.createDataFrame(priced, rates),
    )
    got = unit_days.unit_day_base(data, D(2025, 1, 2), D(2025, 2, 1)).collect()
    assert len(got) == 3 * 31 + 2  # a second sale, a second price
    rated = sorted((r.unit_id, r.date, r.reservation or 0, r.target_rate, r.current_rate or 0) for r in got if r.target_rate or r.current_rate)
    assert rated == [
        (1, D(2025, 1, 2), 7, 1.0, 0),
        (1, D(2025, 1, 2), 8, 1.0, 0),
        (1, D(2025, 1, 30), 0, 3.0, 0),
        (1, D(2025, 1, 31), 0, 2.0, 4.0),
        (1, D(2025, 1, 31), 0, 2.0, 5.0),
        (3, D(2025, 2, 1), 0, None, 6.0),
    ]


def test_spine_text_is_the_same_with_and_without_a_list_of_days(spark, rows):
    days = [D(1995, 1, 1), D(1996, 2, 29), D(1996, 12, 31), D(1994, 12, 31), D(1997, 1, 1), D(812, 3, 4), None]
    df = spark.createDataFrame([(i, "m", d) for i, d in enumerate(days)], "id long, manager string, date date")
    listed = dimensions.spine_text(df, D(1995, 1, 1), D(1996, 12, 31))
    texts = ["01/01/1995", "02/29/1996", "12/31/1996", "12/31/1994", "01/01/1997", "03/04/0812", None]
    assert rows(listed) == rows(dimensions.spine_text(df)) == sorted((str(i), "m", t) for i, t in enumerate(texts))


def test_free_days_cost_what_differs_between_days_only(spark):
    """Texts of a unit's attributes are made before its days; days come out of compiled code."""
    text = F.concat_ws("|", F.coalesce("name", F.lit("~")), F.col("unit_id").cast("string"))
    got = unit_days.unit_day_base(inputs(spark, sales(spark)), D(2025, 1, 1), D(2025, 3, 3), per_unit={"both": text})
    assert got.count() == 3 * 62 + 1 and got.where(~F.col("both").eqNullSafe(text)).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    free = plan[plan.rindex("Generate explode") :]
    assert "lambda" not in plan and "concat_ws" in free


def test_row_text_is_that_of_all_values(spark):
    from innkeep.domain import queries_marts as M

    columns = sorted(["unit_id", "name", "date", "email", "enddate", "price", "price_total", "season", "season_name", "reservation"])
    day = D(1989, 12, 31)
    data = [
        (1, "a", day, None, None, None, None, None, None, None),
        (2, None, D(2004, 12, 31), "x", day, 1.005, 2.0, "s", "t", 7),
        (None, "b", None, None, D(2005, 1, 1), None, 3.0, None, "t", None),
    ]
    shape = "unit_id long, name string, date date, email string, enddate date, price double, price_total double, season string, season_name string, reservation long"
    df = spark.createDataFrame(data, shape)
    plain = [F.coalesce((F.col(c).cast("decimal(18,2)") if c.startswith("price") else F.col(c)).cast("string"), F.lit("~")) for c in columns]
    for rows in (df, df.withColumns(M._unit_texts(columns))):
        assert rows.where(M._row_text(rows, columns) != F.concat_ws("|", *plain)).isEmpty()
