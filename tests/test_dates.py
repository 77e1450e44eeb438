import datetime as dt

import pytest
from pyspark.sql import functions as F

from innkeep.functions import dates as D
from innkeep.plans import dimensions
from innkeep.plans.occupancy import request_months

FLEX = {
    "03/04/2025": dt.date(2025, 3, 4),
    "13/04/2025": dt.date(2025, 4, 13),
    "04/13/2025": dt.date(2025, 4, 13),
    "13/13/2025": None,
    "2025-04-13": dt.date(2025, 4, 13),
    "03-04-2025": dt.date(2025, 3, 4),
    "25-12-2025": dt.date(2025, 12, 25),
    "02/30/2025": None,
    "3/4/2025": None,
    "2025-04-13 00:00:00": None,
    "": None,
    "abc": None,
    None: None,
}


def test_flexible_dates(spark):
    df = spark.createDataFrame([(k,) for k in FLEX], "raw string")
    got = {r.raw: r.day for r in df.select("raw", D.parse_date_flex("raw").alias("day")).collect()}
    assert got == FLEX


def test_typed_dates_pass_through(spark):
    df = spark.sql("select timestamp_ntz'2025-04-13 10:00:00' as t, date'2025-04-13' as d, '04/13/2025' as s")
    got = df.select(*[D.as_date(df, c) for c in df.columns]).first()
    assert set(got) == {dt.date(2025, 4, 13)}


@pytest.mark.parametrize(
    "raw, day",
    [("1/2/2025", dt.date(2025, 1, 2)), ("01/02/2025", dt.date(2025, 1, 2)), ("2025-01-02", None)],
)
def test_fixed_format(value, raw, day):
    assert value(D.parse_date("a"), a=raw) == day


@pytest.mark.parametrize(
    "raw, day",
    [
        ("13/04/2025", dt.date(2025, 4, 13)),
        ("03/04/2025", dt.date(2025, 4, 3)),
        ("2025-04-13", dt.date(2025, 4, 13)),
        ("04/13/2025", None),
    ],
)
def test_day_first(value, raw, day):
    assert value(D.parse_date_day_first("a"), a=raw) == day


@pytest.mark.parametrize(
    "raw, text",
    [
        ("01/02/2025  10:00:00   EST", "01/02/2025 10:00:00 -05:00"),
        ("01/02/2025 10:00:00 PDT", "01/02/2025 10:00:00 -07:00"),
        ("01/02/2025 10:00:00 XYZ", "01/02/2025 10:00:00 XYZ"),
        ("01/02/2025 10:00:00", "01/02/2025 10:00:00"),
        (None, None),
    ],
)
def test_zone_letters(value, raw, text):
    assert value(D.zone_to_offset("a"), a=raw) == text


@pytest.mark.parametrize(
    "raw, wall",
    [
        ("01/02/2025 10:00:00 EST", dt.datetime(2025, 1, 2, 12, 0)),
        ("07/02/2025 10:00:00 EDT", dt.datetime(2025, 7, 2, 11, 0)),
        ("2025-01-02 10:00:00.900", dt.datetime(2025, 1, 2, 7, 0)),
        ("2025-01-02T10:00:00Z", dt.datetime(2025, 1, 2, 7, 0)),
        ("1/2/2025 9:05", dt.datetime(2025, 1, 2, 6, 5)),
        ("1/2/2025 9:05 PM", dt.datetime(2025, 1, 2, 18, 5)),
        ("01/02/2025 09:05:06 PM EST", dt.datetime(2025, 1, 2, 23, 5, 6)),
        ("2025-01-02", dt.datetime(2025, 1, 1, 21, 0)),
        ("2025-01-02 10:00", dt.datetime(2025, 1, 2, 7, 0)),
        ("2025-01-02T10:00:00+0000", dt.datetime(2025, 1, 2, 7, 0)),
        ("2025-01-02T10:00:00-03", dt.datetime(2025, 1, 2, 10, 0)),
        ("2025-01-02 10:00:00.123456789", dt.datetime(2025, 1, 2, 7, 0)),
        ("01/05/2025 10:30:00.5", dt.datetime(2025, 1, 5, 7, 30)),
        ("2025/01/02 10:00:00", dt.datetime(2025, 1, 2, 7, 0)),
        ("01-15-2025 10:30:00", dt.datetime(2025, 1, 15, 7, 30)),
        ("Jan 5, 2025 10:30", dt.datetime(2025, 1, 5, 7, 30)),
        ("01/02/2025 10:00:00 XYZ", None),
        ("soon", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_business_time_whatever_the_session_zone(spark, value, raw, wall, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert value(D.to_business_time(D.parse_ts("a")), a=raw) == wall
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_local_time_drops_zone_letters(value):
    assert value(D.parse_local_ts("a"), a="01/02/2025 08:00:00 EST") == dt.datetime(2025, 1, 2, 8)


def test_local_time_keeps_the_half_of_the_day(value):
    evening, morning = dt.datetime(2025, 1, 5, 22, 30), dt.datetime(2025, 1, 5, 10, 30)
    for raw in ("01/05/2025 10:30 PM", "01/05/2025 10:30 PM EST"):
        assert value(D.parse_local_ts("a"), a=raw) == evening
    assert value(D.parse_local_ts("a", literal=True), a="01/05/2025 10:30 PM") == morning


# adjusted day -> (ytd, mtd, l7d, week), as of 1998-06-15
RELATIVE = {
    "1998-06-14": ("YTD", "MTD", "L7D", "S"),
    "1998-06-08": ("YTD", "MTD", "L7D", "S"),
    "1998-06-07": ("YTD", "MTD", "-", "S-1"),
    "1998-06-01": ("YTD", "MTD", "-", "S-1"),
    "1998-05-31": ("YTD", "MTG", "-", "-"),
    "1997-06-20": ("YTD", "MTD", "-", "-"),
    "1998-06-15": ("YTG", "MTG", "-", "-"),
    "1999-01-01": ("YTG", "MTG", "-", "-"),
    None: ("YTG", "MTG", "-", "-"),
}


def test_relative_flags(spark, as_of):
    df = spark.createDataFrame([(k,) for k in RELATIVE], "raw string")
    flags = D.relative_flags(F.col("raw").cast("date"), as_of)
    got = {
        r[0]: tuple(r)[1:]
        for r in df.select("raw", *[flags[n] for n in ("ytd", "mtd", "l7d", "week")]).collect()
    }
    assert got == RELATIVE


@pytest.mark.parametrize("day, label", [("1998-01-01", "Y-0"), ("1997-12-31", "Y-1"), ("1999-01-01", "Y--1")])
def test_year_label(value, as_of, day, label):
    assert value(D.year_label(F.col("a").cast("date"), as_of), a=day) == label


def test_month_state(spark, as_of, rows):
    df = spark.sql("select explode(array(date'1998-05-01', date'1998-06-01', date'1998-07-01', date'1996-02-01')) as first")
    state = D.month_state("first", as_of)
    assert rows(df.select(F.date_format("first", "yyyy-MM"), *state.values())) == [
        ("1996-02", 29, 29, 1, 0),
        ("1998-05", 31, 31, 1, 0),
        ("1998-06", 30, 15, 0, 0),
        ("1998-07", 31, 0, 0, 1),
    ]


def test_arrival_days():
    friday = dt.date(1998, 6, 19)
    assert D.arrival_days(friday) == [friday, dt.date(1998, 6, 20), dt.date(1998, 6, 21)]
    assert D.arrival_days(dt.date(1998, 6, 20)) == [dt.date(1998, 6, 20)]


def test_horizon_and_windows(as_of):
    assert D.calendar_end(dt.date(2026, 3, 1)) == dt.date(2029, 12, 30)
    assert D.report_window(as_of) == (dt.date(1998, 6, 10), dt.date(1998, 9, 8))


def test_request_months_reach_into_the_next():
    months = request_months([2024])
    assert len(months) == 12
    assert months[1] == (dt.date(2024, 2, 1), dt.date(2024, 3, 10))
    assert months[11] == (dt.date(2024, 12, 1), dt.date(2025, 1, 10))


def test_calendar(spark, as_of, rows):
    adjusted = spark.createDataFrame(
        [("15-06-1998", dt.date(1998, 6, 14)), ("31-02-1998", dt.date(1998, 1, 1))],
        "day_text string, adjusted_day date",
    )
    cal = dimensions.calendar(spark, dt.date(1998, 6, 14), dt.date(1998, 6, 16), adjusted, as_of)
    assert rows(cal, "day_text", "year_month", "adjusted_day", "ytd", "week", "year_label") == [
        ("14-06-1998", 199806, None, "YTG", "-", "Y-0"),
        ("15-06-1998", 199806, dt.date(1998, 6, 14), "YTD", "S", "Y-0"),
        ("16-06-1998", 199806, None, "YTG", "-", "Y-0"),
    ]


def test_calendar_takes_adjusted_days_as_text(spark, as_of):
    adjusted = spark.createDataFrame([("15-06-1998", "14-06-1998")], "day_text string, adjusted_day string")
    assert dimensions.calendar(spark, as_of, as_of, adjusted, as_of).first().adjusted_day == dt.date(1998, 6, 14)


def test_calendar_without_adjusted_days_uses_today(spark, as_of):
    cal = dimensions.calendar(spark, as_of, as_of, None, as_of)
    row = cal.first()
    assert (row.adjusted_day, row.ytd, row.mtd) == (as_of, "YTG", "MTG")
