"""Queries that join intervals with intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from innkeep.domain import views as V
from innkeep.domain.queries_documents import _calendar_docs
from innkeep.domain.registry import query
from innkeep.operators.intervals import interval_join
from innkeep.operators.stays import spread
from innkeep.plans import occupancy
from innkeep.session import stored

#: About how many different seasons a stay is compared with for each that it meets; it
#: sets the number of tasks only.
SPANS_PER_MEETING = 10

_SEASONS = """SELECT s_suppkey AS season_id, s_nationkey % 5 AS market,
           CAST(DATE '1992-01-01' + CAST(s_suppkey * 37 % 2400 AS INTEGER) AS DATE) AS season_start,
           CAST(DATE '1992-01-01' + CAST(s_suppkey * 37 % 2400 + CASE WHEN s_suppkey % 7 = 0 THEN 1500
                    ELSE s_suppkey * s_suppkey % 90 - 1 END AS INTEGER) AS DATE) AS season_end
    FROM supplier"""


def _seasons(spark, sf) -> DataFrame:
    """Seasons of any length, from one day to four years, some of them reversed."""
    key = F.col("s_suppkey")
    start = (key * 37 % 2400).cast("int")
    length = F.when(key % 7 == 0, 1500).otherwise(key * key % 90 - 1).cast("int")
    first_day = F.lit("1992-01-01").cast("date")
    return V.table(spark, sf, "supplier").select(
        key.alias("season_id"),
        (F.col("s_nationkey") % 5).alias("market"),
        F.date_add(first_day, start).alias("season_start"),
        F.date_add(first_day, start + length).alias("season_end"),
    )


@query(
    "reservations",
    f"""WITH seasons AS ({_SEASONS}),
    periods AS (
        SELECT unit_id, startdate AS s, enddate AS e FROM reservations WHERE days_number > 2 AND status_id <> 4
        UNION ALL
        SELECT unit_id, creation_date, startdate FROM reservations WHERE days_number > 2 AND status_id = 8)
    SELECT unit_id, season_id, count(*) AS periods, min(greatest(s, season_start)) AS first_day,
           max(least(e, season_end)) AS last_day,
           CAST(sum(least(e, season_end) - greatest(s, season_start) + 1) AS BIGINT) AS days
    FROM periods JOIN seasons ON unit_id % 5 = market AND s <= season_end AND e >= season_start
        AND s <= e AND season_start <= season_end
    GROUP BY unit_id, season_id""",
)
def blocked_by_season(spark, sf):
    """Blocked periods, from calendar responses, against their market's seasons.  Equal
    periods of a unit meet a season once, with their number.  All of a unit's are dealt to
    one task before they meet, so that pairs are folded where they arise and, while the
    seasons are small enough to be broadcast, never shuffled."""
    keys = ["unit_id", "startdate", "enddate"]
    found = occupancy.blocked_periods(_calendar_docs(spark, sf)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    periods = stored(found.withColumn("unit_market", F.col("unit_id") % 5), "periods")
    seasons = stored(_seasons(spark, sf), "seasons")
    here, there = periods.groupBy("unit_market").agg(F.count(F.lit(1)).alias("p")), seasons.groupBy("market").count()
    met = here.join(there, F.col("unit_market") == F.col("market")).agg(F.sum(F.col("p") * F.col("count"))).first()[0]
    periods = spread(periods, (met or 0) // SPANS_PER_MEETING, "unit_id")
    pairs = interval_join(
        periods, seasons, ("startdate", "enddate"), ("season_start", "season_end"), {"unit_market": "market"}
    )
    return pairs.groupBy("unit_id", "season_id").agg(
        F.sum("n").alias("periods"),
        F.min("shared_from").alias("first_day"),
        F.max("shared_to").alias("last_day"),
        F.sum(F.col("n") * (F.datediff("shared_to", "shared_from") + 1)).alias("days"),
    )


@query(
    "reservations",
    f"""WITH seasons AS ({_SEASONS})
    SELECT season_id, count(*) AS stays, CAST(sum(least(enddate, season_end) - greatest(startdate, season_start) + 1) AS BIGINT) AS days
    FROM reservations JOIN seasons ON startdate <= season_end AND enddate >= season_start AND season_start <= season_end
    GROUP BY season_id""",
)
def stays_by_season(spark, sf):
    """Stays against all seasons, without any equal key.  Equal stays and equal seasons
    meet once, with their number: pairs grow with the different date spans on either
    side, not with the rows."""
    rows = V.bookings(spark, sf).groupBy("startdate", "enddate").agg(F.count(F.lit(1)).alias("n"))
    stays, seasons = stored(rows, "stay-spans"), _seasons(spark, sf)
    spans = stored(seasons.select("season_start", "season_end").distinct(), "season-spans")
    stays = spread(stays, stays.count() * spans.count() // SPANS_PER_MEETING)
    pairs = interval_join(stays, spans, ("startdate", "enddate"), ("season_start", "season_end"))
    per_span = pairs.groupBy("season_start", "season_end").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.datediff("shared_to", "shared_from") + 1)).alias("shared")
    )
    return seasons.join(per_span, ["season_start", "season_end"]).groupBy("season_id").agg(
        F.sum("n").alias("stays"), F.sum("shared").alias("days")
    )
