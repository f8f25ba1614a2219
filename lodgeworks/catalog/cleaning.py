"""Cleaning: dates, duplicates, nulls, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.registry import (
    NUMBERS,
    REPAIRED_SAME_YEAR,
    TEXTS,
    long_sql,
    mode_of,
    over_bookings,
    over_cleaned,
    query,
    repaired,
)
from lodgeworks.fields import DATE_PARTS, FEATURE_TABLE, ID_COLUMN, MODEL_FEATURES, RAW_SCHEMA, TARGET
from lodgeworks.functions.columns import absent_columns, number_columns, present, string_columns
from lodgeworks.functions.dates import is_valid_date, parse_date, repair_date, strict_date
from lodgeworks.operators import clean, features, profile, rules
from lodgeworks.operators.quantiles import exact_quantiles
from lodgeworks.plans.ingest import cancellation_by_month, clean_bookings
from lodgeworks.session import staged
from lodgeworks.sources.bookings import bookings, table

RAW = RAW_SCHEMA.fieldNames()


def cleaned(spark, sf, keep_id=True, stage=True):
    return clean_bookings(bookings(spark, sf), keep_id=keep_id, stage=stage)


@query(
    "flagship_cancellation_by_month",
    over_cleaned(
        """SELECT YEAR(booking_date) AS year, MONTH(booking_date) AS month, COUNT(*) AS n_bookings,
        ROUND(AVG(CASE WHEN booking_status = 'Canceled' THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS cancel_rate
        FROM cleaned GROUP BY 1, 2"""
    ),
)
def flagship(spark, sf):
    return cancellation_by_month(cleaned(spark, sf, keep_id=False))


@query(
    "clean_bookings_full",
    over_cleaned(
        """SELECT * EXCLUDE (Booking_ID) REPLACE (ROUND(lead_time, 6) AS lead_time,
        ROUND(arrival_date, 6) AS arrival_date, ROUND(avg_price_per_room, 6) AS avg_price_per_room)
        FROM cleaned"""
    ),
)
def clean_full(spark, sf):
    df = cleaned(spark, sf, keep_id=False)
    return df.withColumns({c: F.round(c, 6) for c in ("lead_time", "arrival_date", "avg_price_per_room")})


# --- projections, filters, predicates -------------------------------------------------------


@query("p1_drop_identifier", over_bookings("SELECT * EXCLUDE (k, Booking_ID) FROM bookings"))
def drop_identifier(spark, sf):
    return clean.drop_id_column(bookings(spark, sf), ID_COLUMN)


@query("p2_drop_ignoring_absent", over_bookings("SELECT * EXCLUDE (k, Booking_ID, booking_status) FROM bookings"))
def drop_ignoring(spark, sf):
    return clean.drop_if_present(bookings(spark, sf), "Booking_ID", "event_timestamp", "booking_status")


@query(
    "p3_split_target",
    over_cleaned(
        """SELECT Booking_ID, no_of_week_nights, no_of_weekend_nights,
        DENSE_RANK() OVER (ORDER BY booking_status) - 1 AS booking_status FROM cleaned"""
    ),
)
def split_target(spark, sf):
    df, names = features.split_target(cleaned(spark, sf), encode=True)
    wanted = [c for c in ("Booking_ID", "no_of_week_nights", "no_of_weekend_nights") if c in names]
    return df.select(*wanted, TARGET)


@query(
    "p4_ordered_subset",
    over_bookings(
        "SELECT lead_time, avg_price_per_room, no_of_special_requests, arrival_date, arrival_month FROM bookings"
    ),
)
def ordered_subset(spark, sf):
    return bookings(spark, sf, MODEL_FEATURES).select(*MODEL_FEATURES)


@query("p5_subset_by_names", over_bookings("SELECT lead_time, avg_price_per_room FROM bookings"))
def subset_by_names(spark, sf):
    return profile.select_unique(bookings(spark, sf), ["lead_time", "avg_price_per_room", "lead_time"])


@query(
    "p6_default_columns",
    over_bookings(
        """SELECT k, 0 AS no_of_special_requests, 0 AS arrival_month, lead_time FROM bookings"""
    ),
)
def default_columns(spark, sf):
    df = bookings(spark, sf, ["lead_time"], key=True)
    return features.add_defaults(df, ["no_of_special_requests", "arrival_month", "lead_time"])


@query(
    "p7_cast_projection",
    over_cleaned(
        """SELECT Booking_ID, TRUNC(lead_time)::BIGINT AS lead_time, avg_price_per_room::FLOAT AS avg_price_per_room,
        TRUNC(arrival_date)::BIGINT AS arrival_date FROM uniq"""
    ),
)
def cast_projection(spark, sf):
    df = clean.drop_duplicate_rows(clean.add_booking_date(bookings(spark, sf)))
    return df.select(
        "Booking_ID",
        F.col("lead_time").cast("double").cast("long").alias("lead_time"),
        F.col("avg_price_per_room").cast("float").alias("avg_price_per_room"),
        F.col("arrival_date").cast("long").alias("arrival_date"),
    )


_TEXT = ("Booking_ID", "type_of_meal_plan", "room_type_reserved", "market_segment_type", "booking_status")


@query(
    "p8_columns_by_type",
    over_bookings(
        " UNION ALL ".join(
            f"SELECT '{'text' if c in _TEXT else 'number'}' AS kind, '{c}' AS \"column\", COUNT({c}) AS n_values"
            " FROM bookings"
            for c in RAW
        )
    ),
)
def columns_by_type(spark, sf):
    df = bookings(spark, sf)
    kinds = {**dict.fromkeys(string_columns(df), "text"), **dict.fromkeys(number_columns(df), "number")}
    cells = [
        F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.col(c).alias("n_values"))
        for c, kind in kinds.items()
    ]
    counts = df.agg(*[F.count(c).alias(c) for c in kinds])
    return counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


@query(
    "p9_drop_incomplete_rows",
    over_bookings("SELECT * EXCLUDE (k) FROM bookings WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in RAW)),
)
def drop_incomplete(spark, sf):
    return clean.drop_incomplete_rows(bookings(spark, sf))


_VALID_SQL = """COALESCE(arrival_month BETWEEN 1 AND 12 AND arrival_date >= 1 AND arrival_date <=
  DAY(LAST_DAY(MAKE_DATE(arrival_year, GREATEST(LEAST(arrival_month, 12), 1), 1))), FALSE)"""


@query(
    "p10_invalid_dates_head",
    over_bookings(
        f"""SELECT k, arrival_date, arrival_month, arrival_year FROM bookings WHERE NOT {_VALID_SQL}
        ORDER BY k LIMIT 10"""
    ),
)
def invalid_dates_head(spark, sf):
    df = bookings(spark, sf, DATE_PARTS, key=True)
    return profile.head(df.filter(~is_valid_date(*DATE_PARTS)).select("k", *DATE_PARTS), 10, "k")


@query(
    "p11_out_of_range_counts",
    over_bookings(
        """SELECT SUM(CASE WHEN arrival_date > 31 OR arrival_date < 1 THEN 1 ELSE 0 END)::BIGINT AS bad_days,
        SUM(CASE WHEN arrival_month > 12 OR arrival_month < 1 THEN 1 ELSE 0 END)::BIGINT AS bad_months,
        SUM(CASE WHEN arrival_year > 2100 OR arrival_year < 1900 THEN 1 ELSE 0 END)::BIGINT AS bad_years
        FROM bookings"""
    ),
)
def out_of_range(spark, sf):
    profile_row = clean.date_part_profile(bookings(spark, sf, DATE_PARTS), years=(1900, 2100))
    return profile_row.select(
        F.col("invalid_days").alias("bad_days"), F.col("invalid_months").alias("bad_months"),
        F.col("invalid_years").alias("bad_years"),
    )


@query(
    "p12_membership",
    over_bookings(
        """SELECT booking_status, COUNT(*) AS n FROM bookings WHERE booking_status IN ('Canceled', 'Not_Canceled')
        AND repeated_guest IN (0, 1) GROUP BY 1"""
    ),
)
def membership(spark, sf):
    df = bookings(spark, sf, ["booking_status", "repeated_guest"])
    good = F.col("booking_status").isin("Canceled", "Not_Canceled") & F.col("repeated_guest").isin(0, 1)
    return df.filter(good).groupBy("booking_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p15_request_rows",
    over_cleaned(
        """SELECT Booking_ID, ROUND(lead_time, 6) AS lead_time, ROUND(avg_price_per_room, 6) AS avg_price_per_room,
        no_of_special_requests, TRUNC(arrival_date)::BIGINT AS arrival_date, arrival_month FROM cleaned"""
    ),
)
def request_rows(spark, sf):
    df = cleaned(spark, sf)
    return df.select(
        "Booking_ID",
        F.round(F.col("lead_time").cast("double"), 6).alias("lead_time"),
        F.round("avg_price_per_room", 6).alias("avg_price_per_room"),
        F.col("no_of_special_requests").cast("long").alias("no_of_special_requests"),
        F.col("arrival_date").cast("long").alias("arrival_date"),
        F.col("arrival_month").cast("long").alias("arrival_month"),
    )


_LISTED = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}


@query(
    "p16_column_listing",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", COUNT({c}) AS n_values FROM {t}"
        for t, names in _LISTED.items()
        for c in names
    ),
)
def column_listing(spark, sf):
    parts = None
    for name in _LISTED:
        df = table(spark, sf, name)
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in df.columns]
        part = counts.select(F.lit(name).alias("table"), F.explode(F.array(*cells)).alias("r")).select("table", "r.*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "p17_emptiness",
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", (SELECT COUNT(*) FROM {n}) = 0 AS is_empty" for n in ("orders", "events", "labels")
    ),
)
def emptiness(spark, sf):
    rows = [(n, table(spark, sf, n).isEmpty()) for n in ("orders", "events", "labels")]
    return spark.createDataFrame(rows, "table string, is_empty boolean")


# --- aggregations ---------------------------------------------------------------------------


@query("a1_distinct_rows", over_bookings("SELECT DISTINCT * EXCLUDE (k) FROM bookings"))
def distinct_rows(spark, sf):
    return clean.drop_duplicate_rows(bookings(spark, sf))


@query(
    "a1_distinct_ignoring_id",
    over_bookings(
        """SELECT MIN(Booking_ID) AS Booking_ID, lead_time, arrival_month, market_segment_type FROM bookings
        GROUP BY lead_time, arrival_month, market_segment_type"""
    ),
)
def distinct_ignoring(spark, sf):
    df = bookings(spark, sf, ["Booking_ID", "lead_time", "arrival_month", "market_segment_type"])
    return clean.drop_duplicate_rows(df, ignore=["Booking_ID"])


_DUPLICATES_SQL = """SELECT (SELECT COUNT(*) FROM bookings) AS n_rows, COUNT(*) AS n_distinct,
  (SELECT COUNT(*) FROM bookings) - COUNT(*) AS n_duplicates,
  (SELECT COUNT(*) FROM bookings) > COUNT(*) AS has_duplicates FROM (SELECT DISTINCT * FROM bookings)"""


@query("a2_duplicate_count", over_bookings(_DUPLICATES_SQL))
def duplicate_count(spark, sf):
    return clean.duplicate_summary(bookings(spark, sf))


@query("a3_any_duplicate", over_bookings(f"SELECT has_duplicates FROM ({_DUPLICATES_SQL})"))
def any_duplicate(spark, sf):
    return clean.duplicate_summary(bookings(spark, sf)).select("has_duplicates")


@query(
    "a4_null_counts",
    over_bookings(long_sql("bookings", [(c, f"COUNT(*) - COUNT({c})") for c in RAW], value="n_null")),
)
def null_counts(spark, sf):
    return clean.null_counts(bookings(spark, sf))


@query(
    "a5_total_nulls",
    over_bookings(
        "SELECT (" + " + ".join(f"COUNT(*) - COUNT({c})" for c in RAW) + ")::BIGINT AS n_null FROM bookings"
    ),
)
def total_nulls(spark, sf):
    df = bookings(spark, sf)
    return df.agg(rules.total_nulls(df).alias("n_null"))


@query(
    "a6_all_null_columns",
    over_bookings(long_sql("bookings", [(c, f"COUNT({c}) = 0") for c in RAW], value="all_null")),
)
def all_null(spark, sf):
    df = bookings(spark, sf)
    counts = df.agg(*[(F.count(c) == 0).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("all_null")) for c in df.columns]
    return counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


@query(
    "a7_means",
    over_bookings("SELECT " + ", ".join(f"ROUND(AVG({c}), 6) AS {c}" for c in NUMBERS) + " FROM bookings"),
)
def means(spark, sf):
    df = bookings(spark, sf, NUMBERS)
    return df.agg(*[F.round(F.avg(present(df, c)), 6).alias(c) for c in df.columns])


def _quantile_rows(spark, sf, probs, names=NUMBERS):
    found = exact_quantiles(staged(bookings(spark, sf, names)), names, probs)
    rows = [(c, float(p), round(q, 8)) for c, by in found.items() for p, q in by.items()]
    return spark.createDataFrame(rows, "column string, prob double, value double")


def _quantile_sql(probs, names=NUMBERS):
    return over_bookings(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, ROUND(QUANTILE_CONT({c}, {p}), 8)::DOUBLE AS value"
            " FROM bookings"
            for c in names
            for p in probs
        )
    )


@query("a8_medians", _quantile_sql((0.5,)))
def medians(spark, sf):
    return _quantile_rows(spark, sf, (0.5,))


@query(
    "a9_modes",
    over_cleaned(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, v::VARCHAR AS mode, c AS n FROM (SELECT {c} AS v, COUNT(*) AS c FROM uniq"
            f" WHERE {c} IS NOT NULL GROUP BY 1 QUALIFY ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) = 1)"
            for c in (*TEXTS, "booking_date")
        )
    ),
)
def modes(spark, sf):
    df = clean.drop_duplicate_rows(clean.add_booking_date(bookings(spark, sf)))
    return clean.value_modes(df, [*TEXTS, "booking_date"])


@query("a10_quartiles", _quantile_sql((0.25, 0.75)))
def quartiles(spark, sf):
    return _quantile_rows(spark, sf, (0.25, 0.75))


@query(
    "a12_date_range",
    over_cleaned(
        """SELECT MIN(booking_date) AS first_date, MAX(booking_date) AS last_date, MIN(arrival_date) AS first_day,
        MAX(arrival_date) AS last_day, MIN(arrival_year) AS first_year, MAX(arrival_year) AS last_year FROM uniq"""
    ),
)
def date_range(spark, sf):
    df = clean.add_booking_date(bookings(spark, sf, DATE_PARTS))
    return df.agg(
        F.min("booking_date").alias("first_date"), F.max("booking_date").alias("last_date"),
        F.min("arrival_date").alias("first_day"), F.max("arrival_date").alias("last_day"),
        F.min("arrival_year").alias("first_year"), F.max("arrival_year").alias("last_year"),
    )


@query(
    "a13_valid_counts",
    over_cleaned(
        """SELECT COUNT(*) AS n_rows, COUNT(booking_date) AS valid_dates, COUNT(*) - COUNT(booking_date)
        AS invalid_dates, MIN(booking_date) AS first_date, MAX(booking_date) AS last_date FROM dated"""
    ),
)
def valid_counts(spark, sf):
    return clean.date_summary(clean.add_booking_date(bookings(spark, sf, DATE_PARTS)))


# --- sorts, set operations --------------------------------------------------------------------


@query("t1_head", over_bookings("SELECT k, lead_time FROM (SELECT DISTINCT * FROM bookings) ORDER BY k LIMIT 10"))
def head_rows(spark, sf):
    return profile.head(clean.drop_duplicate_rows(bookings(spark, sf, ["lead_time"], key=True)), 10, "k")


@query("t2_sample_rows")
def sample_rows(spark, sf):
    return profile.sample_rows(bookings(spark, sf), 10)


@query(
    "u1_union_all",
    over_bookings(
        """SELECT market_segment_type, COUNT(*) AS n FROM (SELECT * FROM bookings UNION ALL SELECT * FROM bookings)
        GROUP BY 1"""
    ),
)
def union_all(spark, sf):
    df = bookings(spark, sf, ["market_segment_type"])
    return profile.count_by(df.unionByName(df), "market_segment_type")


@query(
    "u2_absent_columns",
    over_bookings(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows_without FROM bookings"
            for c in FEATURE_TABLE
            if c not in RAW and c != "booking_id"
        )
    ),
)
def absent(spark, sf):
    df = bookings(spark, sf)
    missing = [c for c in absent_columns(df, FEATURE_TABLE) if c != "booking_id"]
    names = F.explode(F.array(*[F.lit(c) for c in missing]))
    return df.agg(F.count(F.lit(1)).alias("n_rows_without")).select(names.alias("column"), "n_rows_without")


# --- scalar functions -------------------------------------------------------------------------


def _dates(spark, sf, expr):
    return bookings(spark, sf, DATE_PARTS, key=True).select("k", *DATE_PARTS, expr.alias("booking_date"))


_DATE_COLUMNS = "k, arrival_date, arrival_month, arrival_year"


@query("f1_repair_date", over_bookings(f"SELECT {_DATE_COLUMNS}, {repaired()} AS booking_date FROM bookings"))
def f1(spark, sf):
    return _dates(spark, sf, repair_date(*DATE_PARTS))


@query(
    "f2_add_booking_date",
    over_bookings(f"SELECT booking_date, COUNT(*) AS n FROM (SELECT {repaired()} AS booking_date FROM bookings) GROUP BY 1"),
)
def f2(spark, sf):
    return clean.add_booking_date(bookings(spark, sf, DATE_PARTS)).groupBy("booking_date").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "f2b_repair_wide_years",
    over_bookings(f"SELECT {_DATE_COLUMNS}, {repaired(1900, 2100, 2023)} AS booking_date FROM bookings"),
)
def f2b(spark, sf):
    return _dates(spark, sf, repair_date(*DATE_PARTS, years=(1900, 2100), default_year=2023))


@query("f2c_repair_same_year", over_bookings(f"SELECT {_DATE_COLUMNS}, {REPAIRED_SAME_YEAR} AS booking_date FROM bookings"))
def f2c(spark, sf):
    return _dates(spark, sf, repair_date(*DATE_PARTS, years=None))


_STRICT_SQL = f"CASE WHEN {_VALID_SQL} THEN {REPAIRED_SAME_YEAR} END"


@query("f2d_strict_date", over_bookings(f"SELECT {_DATE_COLUMNS}, {_STRICT_SQL} AS booking_date FROM bookings"))
def f2d(spark, sf):
    return _dates(spark, sf, strict_date(*DATE_PARTS))


@query(
    "f2e_parse_date",
    """SELECT o_orderkey, STRPTIME(CONCAT_WS('-', DAY(o_orderdate), MONTH(o_orderdate), YEAR(o_orderdate)),
    '%d-%m-%Y')::DATE AS order_date FROM orders""",
)
def f2e(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", parse_date(F.day(d), F.month(d), F.year(d)).alias("order_date")
    )


@query("f2f_is_valid_date", over_bookings(f"SELECT {_DATE_COLUMNS}, {_VALID_SQL} AS is_valid FROM bookings"))
def f2f(spark, sf):
    return bookings(spark, sf, DATE_PARTS, key=True).select(
        "k", *DATE_PARTS, is_valid_date(*DATE_PARTS).alias("is_valid")
    )


@query(
    "f8_fill_nulls",
    over_bookings(
        f"""SELECT k, ROUND(COALESCE(lead_time, (SELECT AVG(lead_time) FROM bookings))::DOUBLE, 6) AS lead_time,
        ROUND(COALESCE(avg_price_per_room, (SELECT AVG(avg_price_per_room) FROM bookings)), 6) AS avg_price_per_room,
        ROUND(COALESCE(arrival_date, (SELECT AVG(arrival_date) FROM bookings))::DOUBLE, 6) AS arrival_date,
        COALESCE(type_of_meal_plan, {mode_of("type_of_meal_plan", "bookings")}) AS type_of_meal_plan FROM bookings"""
    ),
)
def fill_nulls(spark, sf):
    df = clean.fill_nulls(
        bookings(spark, sf, ["lead_time", "avg_price_per_room", "arrival_date", "type_of_meal_plan"], key=True)
    )
    return df.withColumns({c: F.round(c, 6) for c in ("lead_time", "avg_price_per_room", "arrival_date")})


@query(
    "f9_auto_clean",
    over_bookings(
        f"""SELECT k, ROUND(COALESCE(lead_time, (SELECT MEDIAN(lead_time) FROM u))::DOUBLE, 6) AS lead_time,
        ROUND(COALESCE(avg_price_per_room, (SELECT MEDIAN(avg_price_per_room) FROM u)), 6) AS avg_price_per_room,
        ROUND(COALESCE(arrival_date, (SELECT MEDIAN(arrival_date) FROM u))::DOUBLE, 6) AS arrival_date,
        COALESCE(type_of_meal_plan, {mode_of("type_of_meal_plan", "u")}) AS type_of_meal_plan FROM u""",
        "u AS (SELECT DISTINCT k, lead_time, avg_price_per_room, arrival_date, type_of_meal_plan FROM bookings)",
    ),
)
def auto_clean(spark, sf):
    df = clean.auto_clean(
        staged(bookings(spark, sf, ["lead_time", "avg_price_per_room", "arrival_date", "type_of_meal_plan"], key=True))
    )
    return df.withColumns({c: F.round(c, 6) for c in ("lead_time", "avg_price_per_room", "arrival_date")})


@query("f10_set_types", over_bookings(f"SELECT * EXCLUDE (k, Booking_ID), {repaired()} AS booking_date FROM bookings"))
def set_types(spark, sf):
    return clean.set_types(clean.drop_id_column(clean.add_booking_date(bookings(spark, sf))))


@query(
    "f11_as_text",
    over_bookings(
        "SELECT k, arrival_date::VARCHAR AS arrival_date, arrival_month::VARCHAR AS arrival_month FROM bookings"
    ),
)
def as_text(spark, sf):
    return clean.as_text(bookings(spark, sf, ["arrival_date", "arrival_month"], key=True), "arrival_date", "arrival_month")


@query(
    "v14_date_part_profile",
    over_bookings(
        """SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(arrival_date) AS arrival_date_missing,
        COUNT(*) - COUNT(arrival_month) AS arrival_month_missing, COUNT(*) - COUNT(arrival_year) AS arrival_year_missing,
        SUM(CASE WHEN arrival_date > 31 OR arrival_date < 1 THEN 1 ELSE 0 END)::BIGINT AS invalid_days,
        SUM(CASE WHEN arrival_month > 12 OR arrival_month < 1 THEN 1 ELSE 0 END)::BIGINT AS invalid_months,
        SUM(CASE WHEN arrival_year > 2019 OR arrival_year < 2018 THEN 1 ELSE 0 END)::BIGINT AS invalid_years
        FROM bookings"""
    ),
)
def date_part_profile(spark, sf):
    return clean.date_part_profile(bookings(spark, sf, DATE_PARTS))
