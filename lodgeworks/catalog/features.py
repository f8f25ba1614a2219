"""Feature engineering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.cleaning import cleaned
from lodgeworks.catalog.registry import over_bookings, over_cleaned, query
from lodgeworks.fields import CATEGORICAL, TARGET
from lodgeworks.operators import clean, features, models, ordering
from lodgeworks.sources.bookings import bookings, table

RUN_TS = "2024-02-01 00:00:00"
_CODE = "CASE WHEN {c} IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY {c} NULLS LAST) - 1 END AS {c}"


@query(
    "f3_label_encoding",
    over_bookings(f"SELECT k, {', '.join(_CODE.format(c=c) for c in CATEGORICAL)} FROM bookings"),
)
def label_encoding(spark, sf):
    df, _ = features.encode_categories(bookings(spark, sf, CATEGORICAL, key=True))
    return df


@query(
    "f3_label_encoding_large_dictionary",
    over_bookings(f"SELECT k, {_CODE.format(c='Booking_ID')} FROM bookings"),
)
def label_encoding_large(spark, sf):
    """A dictionary of one label per booking, which never visits the driver."""
    df = bookings(spark, sf, ["Booking_ID"], key=True)
    return features.fit_label_codes(df, ["Booking_ID"], driver_labels=100).encode(df)


@query(
    "f3b_label_dictionary",
    over_bookings(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, {c} AS value, ROW_NUMBER() OVER (ORDER BY {c}) - 1 AS code"
            f" FROM (SELECT DISTINCT {c} FROM bookings WHERE {c} IS NOT NULL)"
            for c in CATEGORICAL
        )
    ),
)
def label_dictionary(spark, sf):
    return features.fit_label_codes(bookings(spark, sf, CATEGORICAL), CATEGORICAL).table()


@query(
    "f4_target_encoding",
    over_bookings("SELECT k, DENSE_RANK() OVER (ORDER BY booking_status) - 1 AS booking_status FROM bookings"),
)
def target_encoding(spark, sf):
    df = bookings(spark, sf, [TARGET], key=True)
    return features.split_target(df, encode=True)[0]


@query(
    "f5_target_fallback_map",
    over_bookings("SELECT k, CASE WHEN booking_status = 'Canceled' THEN 1 ELSE 0 END::BIGINT AS booking_status FROM bookings"),
)
def target_fallback(spark, sf):
    return bookings(spark, sf, [TARGET], key=True).withColumn(TARGET, features.target_from_text())


_STAY = ["no_of_weekend_nights", "no_of_week_nights", "repeated_guest"]


@query("f6_total_nights", over_bookings("SELECT k, no_of_weekend_nights + no_of_week_nights AS total_nights_stayed FROM bookings"))
def total_nights(spark, sf):
    return features.add_stay_features(bookings(spark, sf, _STAY, key=True)).select("k", "total_nights_stayed")


@query(
    "f7_repeat_guest",
    over_bookings("SELECT k, CASE WHEN repeated_guest::VARCHAR = 'Yes' THEN 1 ELSE 0 END::BIGINT AS is_repeat_guest FROM bookings"),
)
def repeat_guest(spark, sf):
    return features.add_stay_features(bookings(spark, sf, _STAY, key=True)).select("k", "is_repeat_guest")


@query(
    "f7_repeat_guest_numeric",
    over_bookings("SELECT k, repeated_guest AS is_repeat_guest FROM bookings"),
)
def repeat_guest_numeric(spark, sf):
    df = features.add_stay_features(bookings(spark, sf, _STAY, key=True), true_values=("Yes", "1"))
    return df.select("k", "is_repeat_guest")


@query(
    "t3_contiguous_ids",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS booking_id FROM orders",
)
def contiguous_ids(spark, sf):
    return ordering.number_rows(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "t3_contiguous_ids_from_one",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS booking_number FROM orders",
)
def contiguous_ids_from_one(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordering.number_rows(df, ["o_orderdate", "o_orderkey"], "booking_number", start=1).drop("o_orderdate")


@query(
    "f16_run_timestamp",
    over_bookings(f"SELECT k, TIMESTAMP '{RUN_TS}' AS event_timestamp FROM bookings"),
)
def run_timestamp(spark, sf):
    return bookings(spark, sf, [], key=True).withColumn("event_timestamp", F.lit(RUN_TS).cast("timestamp_ntz"))


_TABLE_SQL = f"""SELECT ROW_NUMBER() OVER (ORDER BY Booking_ID) - 1 AS booking_id,
  TIMESTAMP '{RUN_TS}' AS event_timestamp, booking_date, TRUNC(lead_time)::BIGINT AS lead_time,
  avg_price_per_room::FLOAT AS avg_price_per_room, no_of_special_requests,
  TRUNC(arrival_date)::BIGINT AS arrival_date, arrival_month,
  CASE WHEN booking_status = 'Canceled' THEN 0 ELSE 1 END::BIGINT AS booking_status FROM cleaned"""


def feature_rows(spark, sf):
    """The feature table without importance selection, key order by the booking identifier."""
    df = cleaned(spark, sf)
    coded = features.fit_label_codes(df, [TARGET]).encode(df)
    numbered = ordering.number_rows(coded, ["Booking_ID"], "_number").drop("Booking_ID")
    return features.to_feature_table(numbered.withColumnRenamed("_number", "booking_id"), RUN_TS)


_ROUNDED = "* REPLACE (ROUND(avg_price_per_room::DOUBLE, 3) AS avg_price_per_room)"


@query("v13_feature_table", over_cleaned(f"SELECT {_ROUNDED} FROM ({_TABLE_SQL})"))
def feature_table(spark, sf):
    return feature_rows(spark, sf).withColumn("avg_price_per_room", F.round(F.col("avg_price_per_room").cast("double"), 3))


@query("v12_feature_table_check", over_cleaned("SELECT COUNT(*) AS n_rows, 0::BIGINT AS n_type_warnings FROM cleaned"))
def feature_table_check(spark, sf):
    df = feature_rows(spark, sf)
    warnings = features.check_feature_table(df)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(warnings)).cast("long").alias("n_type_warnings"))


@query(
    "j4_target_by_key",
    over_bookings(
        """SELECT k, x.lead_time, y.booking_status FROM (SELECT DISTINCT k, lead_time FROM bookings) x
        JOIN (SELECT DISTINCT k, booking_status FROM bookings) y USING (k)"""
    ),
)
def target_by_key(spark, sf):
    left = clean.drop_duplicate_rows(bookings(spark, sf, ["lead_time"], key=True))
    right = clean.drop_duplicate_rows(bookings(spark, sf, [TARGET], key=True))
    return left.join(right, "k")


@query(
    "j5_date_by_key",
    over_cleaned("SELECT Booking_ID, no_of_week_nights, booking_date FROM uniq"),
)
def date_by_key(spark, sf):
    df = clean.drop_duplicate_rows(clean.add_booking_date(bookings(spark, sf)))
    return df.select("Booking_ID", "no_of_week_nights").join(df.select("Booking_ID", "booking_date"), "Booking_ID")


_SEGMENTS = {0: "Online", 1: "Offline", 2: "Corporate", 3: "Aviation"}


@query(
    "j6_dictionary_lookup",
    over_bookings(
        """SELECT k, CASE code WHEN 0 THEN 'Online' WHEN 1 THEN 'Offline' WHEN 2 THEN 'Corporate'
        WHEN 3 THEN 'Aviation' ELSE 'Online' END AS segment
        FROM (SELECT k, DENSE_RANK() OVER (ORDER BY market_segment_type) - 1 AS code FROM bookings)"""
    ),
)
def dictionary_lookup(spark, sf):
    df = bookings(spark, sf, ["market_segment_type"], key=True)
    coded = features.fit_label_codes(df, ["market_segment_type"]).encode(df)
    return coded.select("k", features.lookup("market_segment_type", _SEGMENTS, "Online").alias("segment"))


def _importance(spark, sf):
    df = features.add_stay_features(cleaned(spark, sf))
    coded, _ = features.encode_categories(df, [*CATEGORICAL, TARGET])
    columns = [c for c in coded.columns if c not in ("Booking_ID", TARGET, "booking_date")]
    return models.feature_importance(coded, columns, TARGET)


@query("m2_feature_importance")
def importance(spark, sf):
    return _importance(spark, sf)


@query("t4_top_features")
def top_features(spark, sf):
    return models.top_features(_importance(spark, sf), 20)


@query("t7_important_features")
def important(spark, sf):
    return models.important_features(_importance(spark, sf))
