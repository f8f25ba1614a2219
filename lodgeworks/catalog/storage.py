"""Scans and sinks: each query writes to a fresh folder of the shared directory and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.cleaning import RAW, cleaned
from lodgeworks.catalog.features import _TABLE_SQL, feature_rows
from lodgeworks.catalog.registry import over_bookings, over_cleaned, query
from lodgeworks.fields import MODEL_FEATURES, RAW_SCHEMA
from lodgeworks.operators.split import add_split
from lodgeworks.operators.store import TableSource
from lodgeworks.plans.ingest import load_training_rows, publish_features
from lodgeworks.session import fresh_path
from lodgeworks.sources import files
from lodgeworks.sources.bookings import bookings, table


@query("s1_csv_scan", over_bookings("SELECT * EXCLUDE (k) FROM bookings"))
def csv_scan(spark, sf):
    path = fresh_path(spark, "raw-csv")
    files.write_csv(bookings(spark, sf), path)
    return files.read_csv(spark, path, RAW_SCHEMA).select(*RAW)


@query(
    "s2_parquet_scan",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def parquet_scan(spark, sf):
    orders = files.read_parquet(spark, f"{sf}/orders.parquet")
    return orders.filter("o_orderstatus = 'F' AND o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query(
    "s3_cleaned_parquet_sink",
    over_cleaned(
        """SELECT Booking_ID, booking_date, booking_status, arrival_month FROM cleaned
        WHERE arrival_year = 2017 AND arrival_month = 5"""
    ),
)
def cleaned_sink(spark, sf):
    path = fresh_path(spark, "cleaned")
    files.write_parquet(cleaned(spark, sf), path, partition_by=("arrival_year", "arrival_month"))
    month = files.read_parquet(spark, path).filter("arrival_year = 2017 AND arrival_month = 5")
    return month.select("Booking_ID", "booking_date", "booking_status", F.col("arrival_month").cast("long").alias("arrival_month"))


@query(
    "s4_cleaned_csv_sink",
    over_cleaned("SELECT Booking_ID, type_of_meal_plan, no_of_week_nights, booking_date FROM cleaned"),
)
def cleaned_csv(spark, sf):
    path = fresh_path(spark, "cleaned-csv")
    df = cleaned(spark, sf).select("Booking_ID", "type_of_meal_plan", "no_of_week_nights", "booking_date")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


@query("s5_feature_table_sink", over_cleaned(
    f"SELECT * REPLACE (ROUND(avg_price_per_room::DOUBLE, 3) AS avg_price_per_room) FROM ({_TABLE_SQL})"))
def feature_sink(spark, sf):
    path = fresh_path(spark, "features")
    publish_features(feature_rows(spark, sf), path)
    stored = files.read_parquet(spark, f"{path}/feature_table.parquet")
    return stored.withColumn("avg_price_per_room", F.round(F.col("avg_price_per_room").cast("double"), 3))


@query("s6_feature_csv_sink", over_cleaned(f"SELECT booking_id, lead_time, arrival_month, booking_status FROM ({_TABLE_SQL})"))
def feature_csv(spark, sf):
    path = fresh_path(spark, "features-csv")
    df = feature_rows(spark, sf).select("booking_id", "lead_time", "arrival_month", "booking_status")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


@query(
    "s7_training_reload",
    over_cleaned(
        f"""SELECT booking_id, lead_time, ROUND(avg_price_per_room::DOUBLE, 3) AS avg_price_per_room,
        no_of_special_requests, arrival_date, arrival_month, booking_status FROM ({_TABLE_SQL})"""
    ),
)
def training_reload(spark, sf):
    path = fresh_path(spark, "features")
    publish_features(feature_rows(spark, sf), path)
    rows = load_training_rows(spark, path)
    return rows.withColumn("avg_price_per_room", F.round(F.col("avg_price_per_room").cast("double"), 3))


@query(
    "s8_prediction_log_append",
    over_bookings(
        """SELECT k, no_of_special_requests, arrival_month,
        CASE WHEN lead_time > 200 THEN 1 ELSE 0 END::BIGINT AS booking_status FROM bookings"""
    ),
)
def prediction_log(spark, sf):
    path = fresh_path(spark, "prediction-log")
    df = bookings(spark, sf, ["no_of_special_requests", "arrival_month", "lead_time"], key=True)
    scored = df.select(
        "k", "no_of_special_requests", "arrival_month",
        F.when(F.col("lead_time") > 200, 1).otherwise(0).cast("long").alias("booking_status"),
    )
    for part in (F.col("k") % 2 == 0, F.col("k") % 2 == 1):
        files.append_log(scored.filter(part), path)
    return spark.read.parquet(path)


_SPLIT_SQL = """CASE WHEN h < 700 THEN 'train' WHEN h < 910 THEN 'valid' ELSE 'test' END"""
_HASH_SQL = "((((k % 2147483647) * 48271 + 42) % 2147483647) * 48271 % 2147483647) % 1000"


@query(
    "s10_split_sink",
    over_bookings(
        f"""SELECT k, lead_time, {_SPLIT_SQL} AS split FROM
        (SELECT DISTINCT k, lead_time, {_HASH_SQL} AS h FROM bookings)"""
    ),
)
def split_sink(spark, sf):
    path = fresh_path(spark, "splits")
    df = add_split(bookings(spark, sf, ["lead_time"], key=True).distinct(), "k")
    files.write_parquet(df, path, partition_by=("split",))
    return spark.read.parquet(path)


@query("s12_feature_source", "SELECT user_id, ts, value FROM events WHERE event_type = 'view'")
def feature_source(spark, sf):
    source = TableSource(f"{sf}/events.parquet", timestamp="ts")
    return source.read(spark).filter("event_type = 'view'").select("user_id", source.timestamp, "value")


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("s15_csv_tables", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", COUNT(*) AS n_rows FROM {t}" for t in _TABLES))
def csv_tables(spark, sf):
    root, schemas = fresh_path(spark, "csv"), {}
    for name in _TABLES:
        df = table(spark, sf, name)
        schemas[name] = df.schema
        files.write_csv(df, f"{root}/{name}")
    scans = files.read_csv_tables(spark, {n: f"{root}/{n}" for n in _TABLES}, schemas)
    parts = None
    for name, df in scans.items():
        # Counting a column makes the reader parse the rows, so that a malformed one is noticed.
        row = df.agg(F.count(df.columns[0]).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        parts = row if parts is None else parts.unionByName(row)
    return parts


@query("m1_split_70_21_9", over_bookings(
    f"SELECT split, COUNT(*) AS n FROM (SELECT {_SPLIT_SQL} AS split FROM (SELECT {_HASH_SQL} AS h FROM bookings)) GROUP BY 1"))
def split_sizes(spark, sf):
    return add_split(bookings(spark, sf, [], key=True), "k").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("m1b_split_80_20", over_bookings(
    f"SELECT CASE WHEN h < 800 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n FROM (SELECT {_HASH_SQL} AS h FROM bookings) GROUP BY 1"))
def split_sizes_two(spark, sf):
    df = add_split(bookings(spark, sf, [], key=True), "k", (("train", 800), ("test", 200)))
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_SCALED = MODEL_FEATURES


@query(
    "f15_standard_scaling",
    over_bookings(
        "SELECT k, split, "
        + ", ".join(
            f"ROUND(({c} - (SELECT AVG({c}) FROM t WHERE split = 'train')) / "
            f"(SELECT STDDEV_POP({c}) FROM t WHERE split = 'train'), 6)::DOUBLE AS {c}"
            for c in _SCALED
        )
        + " FROM t",
        f"t AS (SELECT *, {_SPLIT_SQL} AS split FROM (SELECT *, {_HASH_SQL} AS h FROM bookings))",
    ),
)
def scaling(spark, sf):
    from lodgeworks.operators.split import fit_scaler

    df = add_split(bookings(spark, sf, _SCALED, key=True), "k")
    scaled = fit_scaler(df.filter("split = 'train'"), _SCALED).scale(df)
    return scaled.withColumns({c: F.round(c, 6) for c in _SCALED})
