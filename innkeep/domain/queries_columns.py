"""Queries of the column functions and cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from innkeep.domain import views as V
from innkeep.domain.registry import query
from innkeep.functions import dates as D, numbers as N, text as X
from innkeep.operators import cleaning as C, columns as P, rows as R


def _by_priority(values: dict[str, Column | str], default: Column | str) -> Column:
    out = None
    for kind, value in values.items():
        hit = F.col("o_orderpriority") == kind
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def _raw_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as text in five shapes, one of them unreadable."""
    day = F.col("o_orderdate").cast("date")
    raw = _by_priority(
        {
            "1-URGENT": F.date_format(day, "MM/dd/yyyy"),
            "2-HIGH": F.date_format(day, "dd/MM/yyyy"),
            "3-MEDIUM": F.date_format(day, "yyyy-MM-dd"),
            "4-NOT SPECIFIED": F.date_format(day, "dd-MM-yyyy"),
        },
        F.concat(F.lit("on "), F.date_format(day, "yyyyMMdd")),
    )
    return V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), day.alias("day"), raw.alias("raw")
    )


_RAW_DATES = """
raw_dates AS (
    SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day,
           CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%m/%d/%Y')
                WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
                WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d-%m-%Y')
                ELSE 'on ' || strftime(o_orderdate, '%Y%m%d') END AS raw
    FROM orders)
"""


@query(
    "",
    f"""WITH {_RAW_DATES}
    SELECT id, raw,
           CAST(CASE WHEN regexp_matches(raw, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN
                CASE WHEN CAST(raw[1:2] AS INTEGER) > 12 THEN try_strptime(raw, '%d/%m/%Y')
                     ELSE try_strptime(raw, '%m/%d/%Y') END
           WHEN regexp_matches(raw, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN try_strptime(raw, '%Y-%m-%d')
           WHEN regexp_matches(raw, '^[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}$') THEN
                CASE WHEN CAST(raw[1:2] AS INTEGER) > 12 THEN try_strptime(raw, '%d-%m-%Y')
                     ELSE try_strptime(raw, '%m-%d-%Y') END
           END AS DATE) AS parsed
    FROM raw_dates""",
)
def parse_mixed_dates(spark, sf):
    """Mixed date texts: day-first only when the first part exceeds 12."""
    return _raw_dates(spark, sf).select("id", "raw", D.parse_date_flex("raw").alias("parsed"))


@query(
    "",
    f"""WITH {_RAW_DATES}
    SELECT id, raw, CAST(try_strptime(raw, '%m/%d/%Y') AS DATE) AS month_first,
           CAST(coalesce(try_strptime(raw, '%d/%m/%Y'), try_strptime(raw, '%Y-%m-%d')) AS DATE) AS day_first
    FROM raw_dates""",
)
def parse_fixed_dates(spark, sf):
    """Fixed-format and day-first parsing, NULL when unreadable."""
    return _raw_dates(spark, sf).select(
        "id",
        "raw",
        D.parse_date("raw").alias("month_first"),
        D.parse_date_day_first("raw").alias("day_first"),
    )


@query(
    "",
    f"""WITH {_RAW_DATES},
    bad AS (SELECT raw FROM raw_dates WHERE try_strptime(raw, '%m/%d/%Y') IS NULL)
    SELECT 'raw' AS column_name, count(*) AS unparsed, min(raw) AS sample_low,
           max(raw) AS sample_high FROM bad""",
)
def unparsed_report(spark, sf):
    """Count and samples of texts that did not parse."""
    return C.unparsed_report(_raw_dates(spark, sf), {"raw": D.parse_date("raw")})


@query(
    "",
    f"""WITH {_RAW_DATES}
    SELECT id, raw FROM raw_dates
    WHERE coalesce(try_strptime(raw, '%d/%m/%Y'), try_strptime(raw, '%Y-%m-%d')) IS NULL""",
)
def unparsed_rows(spark, sf):
    """Rows whose text is present but does not parse."""
    rows = _raw_dates(spark, sf).withColumn("parsed", D.parse_date_day_first("raw"))
    return C.unparsed(rows, "raw", "parsed").select("id", "raw")


@query(
    "",
    f"""WITH {_RAW_DATES}
    SELECT DISTINCT raw FROM raw_dates WHERE try_strptime(raw, '%m/%d/%Y') IS NULL ORDER BY raw LIMIT 5""",
)
def unparsed_samples(spark, sf):
    """The first five texts that did not parse (a top-k report)."""
    rows = _raw_dates(spark, sf).withColumn("parsed", D.parse_date("raw"))
    return C.unparsed_samples(rows, "raw", "parsed")


@query(
    "",
    f"""WITH {_RAW_DATES}
    SELECT id, day AS iso_text, raw AS mixed_text FROM raw_dates""",
)
def cast_if_all_parse(spark, sf):
    """Text columns become dates only when every value parses."""
    rows = _raw_dates(spark, sf).select(
        "id", F.date_format("day", "yyyy-MM-dd").alias("iso_text"), F.col("raw").alias("mixed_text")
    )
    return C.cast_if_all_parse(rows, ["iso_text", "mixed_text"])


@query(
    "",
    """SELECT event_id,
           CASE event_type
                WHEN 'error' THEN date_trunc('second', ts) + INTERVAL 2 HOUR
                WHEN 'click' THEN date_trunc('second', ts) + INTERVAL 4 HOUR
                WHEN 'view' THEN date_trunc('second', ts) - INTERVAL 3 HOUR
                WHEN 'purchase' THEN date_trunc('second', ts) - INTERVAL 3 HOUR END AS business_time,
           date_trunc('second', ts) AS wall_time,
           CASE event_type WHEN 'error' THEN strftime(ts, '%m/%d/%Y %H:%M:%S') || ' -05:00'
                WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -07:00'
                WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                WHEN 'purchase' THEN strftime(ts, '%m/%d/%Y %H:%M:%S') || ' +00:00'
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' XYZ' END AS with_offset
    FROM events""",
)
def timezone_normalise(spark, sf):
    """Zone letters to offsets, mixed timestamps to UTC, then to business time."""
    us, iso = F.date_format("ts", "MM/dd/yyyy HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = (
        F.when(F.col("event_type") == "error", F.concat(us, F.lit(" EST")))
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), iso, F.lit("   PDT")))
        .when(F.col("event_type") == "view", iso)
        .when(F.col("event_type") == "purchase", F.concat(us, F.lit(" UTC")))
        .otherwise(F.concat(iso, F.lit(" XYZ")))
    )
    rows = V.table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return rows.select(
        "event_id",
        D.to_business_time(D.parse_ts("raw")).alias("business_time"),
        D.parse_local_ts(F.trim("raw")).alias("wall_time"),
        D.zone_to_offset("raw").alias("with_offset"),
    )


@query(
    "reservations",
    """SELECT id, year(startdate) AS year, month(startdate) AS month, day(startdate) AS day,
           year(startdate) * 100 + month(startdate) AS year_month,
           strftime(startdate, '%m. %b') AS month_name, strftime(startdate, '%Y-%m') AS month_str,
           strftime(startdate, '%Y%m%d') AS compact, strftime(startdate, '%d-%m-%Y') AS day_text,
           date_diff('day', creation_date, startdate) AS lead_days,
           CAST(date_trunc('month', startdate) AS DATE) AS first_day,
           last_day(startdate) + 10 AS request_end,
           day(last_day(startdate)) AS days_in_month,
           CASE WHEN date_trunc('month', startdate) > DATE '1998-06-15' THEN 0
                WHEN last_day(startdate) < DATE '1998-06-15' THEN day(last_day(startdate))
                ELSE 15 END AS days_elapsed,
           CAST(last_day(startdate) < DATE '1998-06-15' AS BIGINT) AS is_complete_month,
           CAST(date_trunc('month', startdate) > DATE '1998-06-15' AS BIGINT) AS is_future_month,
           dayofweek(startdate) = 5 AS is_friday
    FROM reservations""",
)
def date_parts(spark, sf):
    """Date parts, formats, month bounds and month state."""
    from innkeep.operators.stays import request_end

    start = F.col("startdate")
    first = D.month_start(start)
    state = D.month_state(first, V.AS_OF)
    return V.bookings(spark, sf).select(
        "id",
        F.year(start).alias("year"),
        F.month(start).alias("month"),
        F.day(start).alias("day"),
        D.year_month(start).alias("year_month"),
        D.month_label(start).alias("month_name"),
        F.date_format(start, "yyyy-MM").alias("month_str"),
        F.date_format(start, "yyyyMMdd").alias("compact"),
        F.date_format(start, "dd-MM-yyyy").alias("day_text"),
        F.datediff(start, "creation_date").alias("lead_days"),
        first.alias("first_day"),
        request_end(first).alias("request_end"),
        *[state[n].alias(n) for n in state],
        (F.weekday(start) == 4).alias("is_friday"),
    )


@query(
    "reservations",
    """SELECT id, lead,
           CASE WHEN lead IS NULL THEN '-' WHEN lead <= 30 THEN '<= 30 days'
                WHEN lead <= 60 THEN '<= 60 days' WHEN lead <= 90 THEN '<= 90 days'
                WHEN lead <= 120 THEN '<= 120 days' WHEN lead <= 180 THEN '<= 180 days'
                ELSE 'Acima de 180 days' END AS lead_band,
           CASE WHEN lead IS NULL THEN '-' WHEN lead <= 30 THEN '1' WHEN lead <= 60 THEN '2'
                WHEN lead <= 90 THEN '3' WHEN lead <= 120 THEN '4' WHEN lead <= 180 THEN '5'
                ELSE '6' END AS lead_order,
           CASE WHEN nights <= 3 THEN '<= 3 nigths' WHEN nights <= 5 THEN '<= 5 nigths'
                WHEN nights <= 7 THEN '<= 7 nigths' WHEN nights <= 10 THEN '<= 10 nigths'
                WHEN nights <= 15 THEN '<= 15 nigths' ELSE 'Acima de 15 nigths' END AS stay_band
    FROM (SELECT id, days_number * 2 AS nights,
                 CASE WHEN status_id <> 8 THEN date_diff('day', creation_date, enddate) END AS lead
          FROM reservations)""",
)
def lead_time_bands(spark, sf):
    """Lead-time and stay-length bands."""
    lead = F.when(F.col("status_id") != 8, F.datediff("enddate", "creation_date"))
    return V.bookings(spark, sf).select(
        "id",
        lead.alias("lead"),
        N.lead_band(lead).alias("lead_band"),
        N.lead_order(lead).alias("lead_order"),
        N.stay_band(F.col("days_number") * 2).alias("stay_band"),
    )


@query(
    "reservations",
    """SELECT id, nights,
           CASE WHEN nights > 0 THEN CAST((2 * cents + nights) // (2 * nights) AS DOUBLE) / 100 END AS rate
    FROM (SELECT id, days_number - 1 AS nights, CAST(round(price_nightly * 100) AS BIGINT) AS cents
          FROM reservations)""",
)
def nightly_rate(spark, sf):
    """Total divided by nights, to the cent; NULL without nights."""
    nights = F.col("days_number") - 1
    return V.bookings(spark, sf).select(
        "id", nights.alias("nights"), N.nightly_rate("price_nightly", nights).alias("rate")
    )


@query(
    "",
    """SELECT o_orderkey AS id, CASE o_orderpriority WHEN '5-LOW' THEN '' ELSE
               CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'A-' ELSE '' END
               || CASE o_orderpriority WHEN '3-MEDIUM' THEN '00' ELSE '' END || o_orderkey END AS normal,
           CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey || '.0'
                WHEN '2-HIGH' THEN '  ' || o_orderkey || ' '
                WHEN '3-MEDIUM' THEN CAST(o_orderkey AS VARCHAR)
                WHEN '4-NOT SPECIFIED' THEN 'A-' || o_orderkey ELSE '' END AS plain,
           CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey WHEN '2-HIGH' THEN o_orderkey
                WHEN '3-MEDIUM' THEN o_orderkey END AS number,
           lower(rtrim(o_orderpriority || '  ')) AS key
    FROM orders""",
)
def key_normalise(spark, sf):
    """Keys as text: trimmed, ``.0`` removed, digits without leading zeros."""
    key = F.col("o_orderkey").cast("string")
    raw = _by_priority(
        {
            "1-URGENT": F.concat(key, F.lit(".0")),
            "2-HIGH": F.concat(F.lit("  "), key, F.lit(" ")),
            "3-MEDIUM": F.concat(F.lit("00"), key),
            "4-NOT SPECIFIED": F.concat(F.lit("A-"), key),
        },
        F.lit(None),
    )
    return V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        X.norm_id(raw).alias("normal"),
        X.id_text(raw).alias("plain"),
        N.to_number(raw, "bigint").alias("number"),
        X.norm_key(F.concat("o_orderpriority", F.lit("  "))).alias("key"),
    )


@query(
    "",
    r"""SELECT doc_id, trim(regexp_replace(text, '[\s\x{0b}\x{85}\p{Z}]+', ' ', 'g')) AS squeezed,
           contains(lower(text), 'the ') AS has_the
    FROM documents""",
)
def squeeze_text(spark, sf):
    """Whole texts with blanks squeezed, and a case-insensitive substring test."""
    return V.table(spark, sf, "documents").select(
        "doc_id", X.squeeze("text").alias("squeezed"), X.contains_ci("text", "The ").alias("has_the")
    )


@query(
    "units",
    """SELECT id, name || CASE WHEN bedrooms_number < 6
                  THEN ' (' || bedrooms_number || 'br/' || bathrooms_number || 'ba)' ELSE '' END AS label,
           trim('Guest ' || coalesce(location_name, '')) AS guest,
           CASE WHEN balance > 0 THEN CAST(CAST(round(balance * 100) AS BIGINT) AS VARCHAR) || '#'
                ELSE CAST(id AS VARCHAR) END AS door_code,
           regexp_replace(regexp_replace(name, '^Customer#0*', 'House '), ' $', ' zero') AS fixed
    FROM units""",
)
def unit_labels(spark, sf):
    """Size labels, full names, door codes and label corrections."""
    size = X.size_label(F.when(F.col("bedrooms_number") < 6, F.col("bedrooms_number")), "bathrooms_number")
    cents = F.round(F.col("balance") * 100).cast("bigint").cast("string")
    return V.units(spark, sf).select(
        "id",
        X.unit_label("name", size).alias("label"),
        X.full_name(F.lit("Guest"), "location_name").alias("guest"),
        N.code_or(cents, "id").alias("door_code"),
        X.fix_labels("name", [("^Customer#0*", "House "), (" $", " zero")]).alias("fixed"),
    )


@query(
    "",
    """SELECT event_id,
           CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'signup' THEN 'abc' END AS token,
           CASE event_type WHEN 'click' THEN CAST(user_id AS DOUBLE) END AS number,
           coalesce(CASE event_type WHEN 'click' THEN CAST(user_id AS DOUBLE) END, -1.0) AS filled,
           CASE WHEN event_type <> 'error' THEN value END AS measure,
           CAST(event_type = 'view' AS BIGINT) AS is_view
    FROM events""",
)
def clean_null_tokens(spark, sf):
    """Null tokens and NaN to NULL, numbers from text, defaults, 0/1 flags."""
    kind = F.col("event_type")
    token = (
        F.when(kind == "click", F.col("user_id").cast("string"))
        .when(kind == "signup", "abc")
        .when(kind == "view", "")
        .when(kind == "error", "NaN")
        .otherwise("None")
    )
    raw = V.table(spark, sf, "events").select(
        "event_id",
        token.alias("token"),
        F.when(kind == "error", float("nan")).otherwise(F.col("value")).alias("measure"),
        N.flag_int(kind == "view").alias("is_view"),
    )
    clean = C.null_tokens(raw)
    number = N.to_number("token")
    return clean.select(
        "event_id",
        "token",
        number.alias("number"),
        F.coalesce(number, F.lit(-1.0)).alias("filled"),
        "measure",
        "is_view",
    )


_LONG_NAME = "a" * 70


@query(
    "",
    f"""SELECT c_custkey AS c_key, c_name AS c_name, c_nationkey AS c_name_1,
           c_acctbal AS x1, c_mktsegment AS x1_1, c_custkey AS {"a" * 64}, c_name AS {"a" * 62}_1
    FROM (SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer)""",
)
def clean_column_names(spark, sf):
    """Column names made storable: separators, brackets, length, repeats."""
    raw = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" c key"),
        F.col("c_name").alias("c.name"),
        F.col("c_nationkey").alias("c-name"),
        F.col("c_acctbal").alias("x(1)"),
        F.col("c_mktsegment").alias("x[1]"),
        F.col("c_custkey").alias(_LONG_NAME),
        F.col("c_name").alias(_LONG_NAME + "b"),
        F.col("c_name").alias("nan"),
    )
    return P.clean_columns(raw)


@query(
    "",
    """SELECT c_custkey AS id, c_name AS name, '' AS note, CAST(NULL AS DOUBLE) AS rate,
           'main' AS manager
    FROM customer""",
)
def conform_columns(spark, sf):
    """Rename, keep what exists, add what is missing, fix order and types."""
    raw = V.table(spark, sf, "customer")
    mapped = P.map_columns(raw, {"name": "c_name", "id": "c_custkey", "note": "c_note"})
    kept = P.keep_present(mapped, ["note", "name", "id", "unknown"])
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("note", T.StringType()),
            T.StructField("rate", T.DoubleType()),
        ]
    )
    return P.conform(kept, schema).withColumn("manager", F.lit("main"))


@query(
    "reservations mirror_units booking_patches",
    """SELECT r.id, coalesce(m.to_id, r.unit_id) AS unit_id,
           coalesce(b.creation_date, r.creation_date) AS creation_date,
           CASE WHEN type_name IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'normal' END AS service
    FROM reservations r LEFT JOIN mirror_units m ON r.unit_id = m.from_id
    LEFT JOIN booking_patches b ON r.id = b.id""",
)
def remap_and_patch(spark, sf):
    """Mirror units to main units, corrected booking dates, value by list."""
    rows = V.bookings(spark, sf).select("id", "unit_id", "creation_date", "type_name")
    rows = C.remap(rows, "unit_id", V.mirror_units(spark, sf))
    rows = C.patch(rows, "id", "creation_date", V.booking_patches(spark, sf))
    rows = rows.withColumn("service", F.lit("normal"))
    return C.set_where_in(rows, "type_name", ["1-URGENT", "2-HIGH"], "service", "fast").drop("type_name")


@query(
    "reservations",
    """SELECT id, status_id FROM reservations
    WHERE status_id NOT IN (4, 6) AND enddate >= DATE '1998-01-01' AND startdate <= DATE '1998-12-31'
      AND price_nightly IS NOT NULL AND coalesce(days_number, 0) > 0""",
)
def filtered_reservations(spark, sf):
    """NOT IN, interval overlap, presence and positivity predicates."""
    import datetime as dt

    return (
        V.bookings(spark, sf)
        .where(
            R.not_in("status_id", [4, 6])
            & R.overlaps("startdate", "enddate", dt.date(1998, 1, 1), dt.date(1998, 12, 31))
            & F.col("price_nightly").isNotNull()
            & (F.coalesce("days_number", F.lit(0)) > 0)
        )
        .select("id", "status_id")
    )
