"""Rental-domain views over the test tables.

Each view here has a SQL twin of the same name in ``views_sql``.  All of them
read whole tables; values the tables lack are derived from the row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from innkeep.functions.dates import calendar_end

AS_OF = dt.date(1998, 6, 15)
YEARS = range(1995, 2002)
HORIZON = (dt.date(1995, 1, 1), calendar_end(AS_OF))
LOAD_TIME = "1998-06-15 02:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_time() -> Column:
    return F.lit(LOAD_TIME).cast("timestamp_ntz")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties: one row per customer."""
    nation = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("location_name"),
            (1 + key % 6).alias("bedrooms_number"),
            (1 + key % 4).alias("bathrooms_number"),
            F.concat(F.lit("TYPE "), F.col("c_nationkey").cast("string")).alias("condo_type_name"),
            F.concat(F.lit("GROUP "), F.col("n_regionkey").cast("string")).alias("condo_type_group_name"),
            (2 + key % 9).alias("max_adults"),
            F.when(F.col("c_acctbal") < 0, "NON-RENTING").otherwise("RENTING").alias("renting_type"),
            F.col("c_mktsegment").alias("manager"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def listed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current property list: units far in debt have been delisted."""
    return units(spark, sf_dir).where("balance >= -500")


def unit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the property list; the later one lacks units in debt and
    has renamed some."""
    every = units(spark, sf_dir)
    first = every.withColumn("load_time", F.lit("1998-06-13 05:00:00").cast("timestamp_ntz"))
    second = every.where("balance >= 0").withColumns(
        {
            "name": F.concat("name", F.when(F.col("balance") > 9500, " II").otherwise("")),
            "load_time": F.lit("1998-06-14 05:00:00").cast("timestamp_ntz"),
        }
    )
    return first.unionByName(second)


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations without their manager: one row per order."""
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    status = F.expr("case o_orderstatus when 'F' then 4 when 'O' then 5 else 8 end")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        key.alias("confirmation_id"),
        F.col("o_custkey").alias("unit_id"),
        (F.col("o_custkey") + 1000).alias("client_id"),
        (1 + key % 8).alias("occupants"),
        (key % 3).alias("occupants_small"),
        F.concat(F.lit("guest"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("Guest").alias("first_name"),
        key.cast("string").alias("last_name"),
        (1 + key % 9).alias("days_number"),
        F.col("o_orderstatus").alias("maketype_description"),
        F.col("o_orderpriority").alias("type_name"),
        status.cast("bigint").alias("status_code"),
        status.cast("bigint").alias("status_id"),
        F.col("o_totalprice").alias("price_nightly"),
        F.col("o_totalprice").alias("price_total"),
        F.date_sub(start, (key % 200).cast("int")).alias("creation_date"),
        start.alias("startdate"),
        F.date_add(start, (1 + key % 9).cast("int")).alias("enddate"),
        start.alias("last_updated"),
    )


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations with the manager of their unit."""
    managers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_unit"), F.col("c_mktsegment").alias("manager")
    )
    rows = bookings(spark, sf_dir)
    return rows.join(managers, rows["unit_id"] == F.col("_unit"), "left").drop("_unit")


def price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nightly prices: one row per line item, loaded on one of two days."""
    load_day = F.date_add(F.lit(dt.date(1998, 6, 13)), F.col("l_linenumber") % 2)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("season"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("extra"),
        F.col("l_discount").alias("discount"),
        F.col("l_quantity").alias("original_cost"),
        F.col("l_orderkey").alias("reservation_id"),
        load_day.cast("timestamp_ntz").alias("data_price"),
        F.lit("loader").alias("manager"),
    )


def mirror_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirror listings and their main unit: units deepest in debt."""
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal < -900")
        .select(key.alias("from_id"), (key + 1).alias("to_id"))
    )


def booking_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected booking dates of the most expensive reservations."""
    return (
        table(spark, sf_dir, "orders")
        .where("o_totalprice > 499000")
        .select(F.col("o_orderkey").alias("id"), F.lit(dt.date(1995, 1, 1)).alias("creation_date"))
    )


def _unit_rates(spark: SparkSession, sf_dir: str, unit_key: str) -> DataFrame:
    managers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    per_day = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col(unit_key).alias("id_unit"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.max("l_returnflag").alias("season"),
            F.max("l_extendedprice").alias("rate"),
            F.min("l_linenumber").cast("bigint").alias("min_stay"),
        )
    )
    return per_day.join(managers, F.col("id_unit") == F.col("c_custkey")).select(
        "id_unit", F.col("c_mktsegment").alias("manager"), "date", "season", "rate", "min_stay"
    )


def target_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rate per unit and day."""
    return _unit_rates(spark, sf_dir, "l_suppkey")


def current_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current price per unit and day."""
    return _unit_rates(spark, sf_dir, "l_partkey")


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target occupancy, season and holiday per manager and day."""
    return (
        reservations(spark, sf_dir)
        .groupBy("manager", F.col("startdate").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("occupancy"),
            F.max("type_name").alias("holiday_name"),
            F.max("days_number").alias("holiday_days"),
            F.min("status_id").alias("holiday_of_year"),
        )
        .withColumns(
            {
                "season": F.when(F.month("date").isin(6, 7, 12), "HIGH").otherwise("LOW"),
                "season_interval": F.date_format("date", "MM. MMM"),
            }
        )
    )


def adjusted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted day of each arrival date: the latest booking made for it."""
    return (
        bookings(spark, sf_dir)
        .groupBy("startdate")
        .agg(F.max("creation_date").alias("adjusted_day"))
        .select(F.date_format("startdate", "dd-MM-yyyy").alias("day_text"), "adjusted_day")
    )


def sale_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale status of booking types; one type has none."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .where("o_orderpriority <> '5-LOW'")
        .select(
            F.upper("o_orderpriority").alias("type_name"),
            F.concat(F.lit("Vendido "), F.col("o_orderpriority")).alias("status"),
        )
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel of booking types."""
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("type_name"))
        .distinct()
        .withColumn("channel", F.concat(F.lit("channel "), F.left("type_name", F.lit(1))))
    )


def target_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units counted towards targets."""
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal > 5000")
        .select(F.col("c_custkey").alias("id_unit"), F.lit("SIM").alias("value"))
    )


def _board(rows: DataFrame, **changes: Column) -> DataFrame:
    board = {
        "reservation": F.col("id").cast("string"),
        "unit": F.concat(F.lit("Unit "), F.col("unit_id").cast("string")),
        "check_in_date": F.col("startdate"),
        "check_out_date": F.col("enddate"),
        "next_arrival": F.date_add("enddate", 3),
        "cleaning_date": F.col("enddate"),
    }
    return rows.select(*[c.alias(name) for name, c in (board | changes).items()])


def board_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's board: reservations in status 4 or 5, some keys with ``.0``."""
    suffix = F.when(F.col("type_name") == "1-URGENT", ".0").otherwise("")
    return _board(
        bookings(spark, sf_dir).where("status_id in (4, 5)"),
        reservation=F.concat(F.col("id").cast("string"), suffix),
    )


def board_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's board: status 5 or 8, with one kind of change per booking type."""

    def later(kind: str, column: str, days: int, extra: int = 0) -> Column:
        moved = F.when(F.col("type_name") == kind, days + extra).otherwise(extra)
        return F.date_add(column, moved)

    moved_unit = F.col("unit_id") + F.when(F.col("type_name") == "5-LOW", 1).otherwise(0)
    return _board(
        bookings(spark, sf_dir).where("status_id in (5, 8)"),
        unit=F.concat(F.lit("Unit "), moved_unit.cast("string")),
        check_in_date=later("3-MEDIUM", "startdate", 1),
        next_arrival=later("2-HIGH", "enddate", 2, 3),
        cleaning_date=later("1-URGENT", "enddate", 1),
    )


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work orders: one row per document, its text as title."""
    tag = F.concat(F.lit(" ("), F.initcap("source"), F.lit(") "))
    opened = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("doc_id") % 365).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("House "), F.col("source")).alias("unit_name"),
        F.when(F.col("lang") != "de", F.concat("text", tag)).otherwise(F.col("text")).alias("title"),
        F.concat(F.date_format(opened, "MM/dd/yyyy"), F.lit(" 08:00:00 EST")).alias("creation_date"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("processor_name"),
        F.concat(F.lit("status "), F.col("lang")).alias("status_name"),
    )
