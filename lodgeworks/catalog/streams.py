"""Streaming queries: each runs a stream over the given tables to its end and reads the result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from lodgeworks.catalog.drift import predictions
from lodgeworks.catalog.learning import _ALL_KEPT, _fitted as fitted, labelled
from lodgeworks.catalog.registry import query
from lodgeworks.plans import train as training
from lodgeworks.session import fresh_path, staged
from lodgeworks.sources.bookings import table
from lodgeworks.streaming import jobs


def _event_stream(spark, sf):
    # The pattern fits a single file as well as a folder of files.
    return jobs.file_stream(spark, f"{sf}/events.parquet*", table(spark, sf, "events").schema)


_LATEST_SQL = """SELECT user_id, ts, value FROM events WHERE event_type = 'view'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


def _pushed(spark, sf):
    root = fresh_path(spark, "push")
    views = _event_stream(spark, sf).filter("event_type = 'view'").select("user_id", "ts", "value")
    jobs.push_features(views, ["user_id"], "ts", f"{root}/latest", f"{root}/checkpoint").awaitTermination()
    return f"{root}/latest"


@query("st1_push_features", _LATEST_SQL)
def push(spark, sf):
    return jobs.latest_pushed(spark, _pushed(spark, sf), ["user_id"], "ts")


@query(
    "s13_push_source_with_ttl",
    f"""SELECT user_id, CASE WHEN ts >= TIMESTAMP '2024-01-29 00:00:00' THEN value END AS value FROM ({_LATEST_SQL})""",
)
def push_ttl(spark, sf):
    rows = jobs.latest_pushed(
        spark, _pushed(spark, sf), ["user_id"], "ts", as_of="2024-01-30 00:00:00", ttl=timedelta(days=1)
    )
    return rows.select("user_id", "value")


def _scored_log(spark, sf):
    data, (best,) = fitted(spark, sf, ["logistic_regression"])
    model = training.scoring_model(data.scaler, best.model)
    root = fresh_path(spark, "scoring")
    requests = labelled(spark, sf).select("booking_id", *data.scaler.columns)
    requests.write.parquet(f"{root}/requests")
    stream = jobs.file_stream(spark, f"{root}/requests", requests.schema, files_per_batch=4)
    jobs.score_stream(
        stream, model, f"{root}/log", f"{root}/checkpoint", ["booking_id", *data.scaler.columns]
    ).awaitTermination()
    return spark.read.parquet(f"{root}/log"), training.score(model, requests, ["booking_id"])


@query("st3_stream_scoring")
def stream_scoring(spark, sf):
    return _scored_log(spark, sf)[0]


@query("st4_stream_log_equals_batch", _ALL_KEPT)
def stream_log(spark, sf):
    log, batch = _scored_log(spark, sf)
    both = log.select("booking_id", F.col("booking_status").alias("a")).join(
        batch.select("booking_id", F.col("booking_status").alias("b")), "booking_id"
    )
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_same"))


_BOUNDS = (0.25, 1.0, 5.0)


@query(
    "st5_request_metrics",
    """SELECT TIME_BUCKET(INTERVAL 15 SECOND, ts) AS slot, COUNT(*) AS n_requests,
    ROUND(SUM(value / 20), 6) AS total_seconds, COUNT(*) FILTER (WHERE value / 20 <= 0.25) AS le_0_25,
    COUNT(*) FILTER (WHERE value / 20 <= 1.0) AS le_1, COUNT(*) FILTER (WHERE value / 20 <= 5.0) AS le_5
    FROM events GROUP BY 1""",
)
def request_metrics(spark, sf):
    root = fresh_path(spark, "metrics")
    log = _event_stream(spark, sf).select("ts", (F.col("value") / 20).alias("duration"))
    jobs.request_metrics_stream(
        log, "ts", "duration", f"{root}/slots", f"{root}/checkpoint", bounds=_BOUNDS
    ).awaitTermination()
    return jobs.latest_metrics(spark, f"{root}/slots").withColumn("total_seconds", F.round("total_seconds", 6))


@query("st6_performance_stream")
def performance(spark, sf):
    root = fresh_path(spark, "performance")
    rows = predictions(spark, sf)
    reference = staged(rows.filter("k % 2 = 0").drop("k"), "reference")
    current = rows.filter("k % 2 = 1").drop("k")
    current.write.parquet(f"{root}/current")
    stream = jobs.file_stream(spark, f"{root}/current", current.schema)
    jobs.performance_stream(
        stream, reference, f"{root}/out", f"{root}/checkpoint", lambda i: "2024-02-01 00:00:00"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out/decision")
