"""Drift and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.registry import NUMBERS, over_bookings, query
from lodgeworks.operators import drift, metrics, sketches
from lodgeworks.plans.monitor import monitor
from lodgeworks.session import fresh_path, staged
from lodgeworks.sources.bookings import bookings, table

RUN_TS = "2024-02-01 00:00:00"
CUT = "2024-01-16 00:00:00"


def _halves(spark, sf, factor: float = 1.0):
    events = table(spark, sf, "events").select("ts", "value")
    first = events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    later = events.filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return first, later.withColumn("value", F.round(F.col("value") * factor, 2)) if factor != 1.0 else later


def _ks_ctes(rows: str) -> list[str]:
    """CTEs that end in ``ks(feature, n_ref, n_cur, d, p_value)`` from ``(feature, value, is_ref)`` rows."""
    return [
        f"cells AS ({rows})",
        "sizes AS (SELECT feature, COUNT(*) FILTER (WHERE is_ref) AS n_ref, COUNT(*) FILTER (WHERE NOT is_ref) AS n_cur"
        " FROM cells GROUP BY 1)",
        "steps AS (SELECT feature, SUM(r) OVER w AS ru, SUM(c) OVER w AS cu FROM (SELECT feature, value,"
        " COUNT(*) FILTER (WHERE is_ref) AS r, COUNT(*) FILTER (WHERE NOT is_ref) AS c FROM cells GROUP BY 1, 2)"
        " WINDOW w AS (PARTITION BY feature ORDER BY value))",
        "gaps AS (SELECT feature, n_ref, n_cur, MAX(ABS(ru / n_ref - cu / n_cur))::DOUBLE AS d"
        " FROM steps JOIN sizes USING (feature) GROUP BY 1, 2, 3)",
        "args AS (SELECT *, GREATEST(ROUND(n_ref * n_cur::DOUBLE / (n_ref + n_cur)), 1.0) AS size FROM gaps)",
        "shifted AS (SELECT *, d * SQRT(size) + 1 / (6 * SQRT(size)) + (d * SQRT(size) - 1) / (4 * size) AS x FROM args)",
        "limits AS (SELECT feature, n_ref, n_cur, d, CASE WHEN d = 0 OR x < 0.2 THEN 1.0 ELSE GREATEST(LEAST((SELECT"
        " SUM((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * EXP(-2.0 * k * k * x * x)) FROM RANGE(1, 101) t(k)), 1.0),"
        " 0.0) END::DOUBLE AS series FROM shifted)",
        # Samples of up to EXACT_ROWS values: the chance to walk from (0, 0) to (n, m) below the distance, step by step.
        f"walk AS (SELECT feature, n_ref AS n, n_cur AS m, ROUND(d * n_ref * n_cur)::BIGINT AS reach, 0::BIGINT AS k,"
        f" list_transform(range(n_ref + 1), lambda i: CASE WHEN i = 0 THEN 1.0 ELSE 0.0 END::DOUBLE) AS p"
        f" FROM gaps WHERE n_ref BETWEEN 1 AND {drift.EXACT_ROWS} AND n_cur BETWEEN 1 AND {drift.EXACT_ROWS}"
        " UNION ALL SELECT feature, n, m, reach, k + 1, list_transform(range(n + 1), lambda i: CASE"
        " WHEN k + 1 - i < 0 OR k + 1 - i > m OR ABS(i * m - (k + 1 - i) * n) >= reach THEN 0.0 ELSE"
        " CASE WHEN i = 0 THEN 0.0 ELSE p[i] * (n - i + 1) / (n + m - k) END"
        " + CASE WHEN k + 1 = i THEN 0.0 ELSE p[i + 1] * (m - k + i) / (n + m - k) END END::DOUBLE)"
        " FROM walk WHERE k < n + m)",
        "exact AS (SELECT feature, CASE WHEN reach <= 0 THEN 1.0 ELSE GREATEST(1 - p[n + 1], 0.0) END AS p FROM walk WHERE k = n + m)",
        "ks AS (SELECT feature, n_ref, n_cur, d, COALESCE(p, series)::DOUBLE AS p_value FROM limits LEFT JOIN exact USING (feature))",
    ]


_KS_OUT = "SELECT feature, n_ref, n_cur, ROUND(d, 9) AS d, ROUND(p_value, 6)::DOUBLE AS p_value FROM ks"


def _rounded(df):
    return df.withColumns({"d": F.round("d", 9), "p_value": F.round("p_value", 6)})


def _events_ks(value: str) -> str:
    rows = (
        f"SELECT 'value' AS feature, CASE WHEN ts < TIMESTAMP '{CUT}' THEN value ELSE {value} END AS value,"
        f" ts < TIMESTAMP '{CUT}' AS is_ref FROM events"
    )
    return "WITH RECURSIVE " + ", ".join(_ks_ctes(rows)) + " "


@query("a24_feature_drift", _events_ks("value") + _KS_OUT)
def feature_drift(spark, sf):
    first, later = _halves(spark, sf)
    return _rounded(drift.feature_drift(first, later, ["value"]))


@query("a24_feature_drift_shifted", _events_ks("ROUND(value * 1.2, 2)") + _KS_OUT)
def feature_drift_shifted(spark, sf):
    first, later = _halves(spark, sf, 1.2)
    return _rounded(drift.feature_drift(first, later, ["value"]))


_BOOKING_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, k % 2 = 0 AS is_ref FROM bookings WHERE {c} IS NOT NULL"
    for c in NUMBERS
)


@query("a24_feature_drift_bookings", over_bookings(_KS_OUT, *_ks_ctes(_BOOKING_ROWS)))
def feature_drift_bookings(spark, sf):
    df = bookings(spark, sf, NUMBERS, key=True)
    even = F.col("k") % 2 == 0
    return _rounded(drift.feature_drift(df.filter(even).drop("k"), df.filter(~even).drop("k")))


@query(
    "a24_sketched_drift_bookings",
    over_bookings("SELECT feature, n_ref, n_cur, true AS within_error FROM ks", *_ks_ctes(_BOOKING_ROWS)),
)
def sketched_drift_bookings(spark, sf):
    """Statistics of merged sketches, each within its error of the exact one."""
    df = staged(bookings(spark, sf, NUMBERS, key=True), "bookings")
    even = F.col("k") % 2 == 0
    parts = sketches.sketch(df.withColumns({"side": even, "part": F.col("k") % 5}), NUMBERS, by=["side", "part"])
    merged = staged(sketches.merge(parts, by=["side"]), "sketches")
    found = sketches.sketched_drift(merged.filter("side").drop("side"), merged.filter("NOT side").drop("side"))
    exact = drift.feature_drift(df.filter(even).drop("k"), df.filter(~even).drop("k")).select("feature", F.col("d").alias("exact"))
    return found.join(exact, "feature").select("feature", "n_ref", "n_cur", (F.abs(F.col("d") - F.col("exact")) <= F.col("error")).alias("within_error"))


@query("a24_data_drift_score", _events_ks("value") + "SELECT ROUND(1 - AVG(p_value), 6)::DOUBLE AS score FROM ks")
def data_drift_score(spark, sf):
    return drift.data_drift(*_halves(spark, sf), ["value"]).select(F.round("score", 6).alias("score"))


_PREDICTED = "CASE WHEN lead_time > 200 THEN 1.0 ELSE 0.0 END"
_LABEL = "CASE WHEN booking_status = 'Canceled' THEN 1.0 ELSE 0.0 END"


def predictions(spark, sf):
    """Bookings with a rule's prediction and the label, as a prediction log would hold them."""
    df = bookings(spark, sf, ["lead_time", "avg_price_per_room", "booking_status"], key=True)
    return df.select(
        "k", "lead_time", "avg_price_per_room",
        F.when(F.col("lead_time") > 200, 1.0).otherwise(0.0).alias("prediction"),
        F.when(F.col("booking_status") == "Canceled", 1.0).otherwise(0.0).alias("label"),
    )


@query(
    "a23_model_drift",
    over_bookings(
        f"""SELECT ROUND(ABS(AVG({_PREDICTED}) FILTER (WHERE k % 2 = 0) - AVG({_PREDICTED}) FILTER (WHERE k % 2 = 1)), 9)
        ::DOUBLE AS score FROM bookings"""
    ),
)
def model_drift(spark, sf):
    df = predictions(spark, sf)
    parts = [df.filter(F.col("k") % 2 == side) for side in (0, 1)]
    return drift.model_drift(*parts).select(F.round("score", 9).alias("score"))


@query(
    "a20_accuracy",
    over_bookings(f"SELECT ROUND(AVG(({_PREDICTED} = {_LABEL})::INT), 9)::DOUBLE AS accuracy FROM bookings"),
)
def accuracy(spark, sf):
    return metrics.accuracy(predictions(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"))


_REPORT_CTES = [
    f"p AS (SELECT {_LABEL} AS label, {_PREDICTED} AS prediction FROM bookings)",
    """per AS (SELECT c.label::DOUBLE::VARCHAR AS class, COUNT(*) FILTER (WHERE p.label = c.label) AS support,
    COUNT(*) FILTER (WHERE p.prediction = c.label) AS given,
    COUNT(*) FILTER (WHERE p.label = c.label AND p.prediction = c.label) AS tp
    FROM p, (SELECT DISTINCT label FROM p) c GROUP BY c.label)""",
    """sc AS (SELECT class, support, tp, COALESCE(tp / NULLIF(given, 0), 0) AS precision,
    COALESCE(tp / NULLIF(support, 0), 0) AS recall,
    COALESCE(2 * tp / NULLIF(given + support, 0), 0) AS f1 FROM per)""",
]
_AVERAGES = """SELECT 'accuracy' AS class, SUM(tp) / SUM(support) AS precision, SUM(tp) / SUM(support) AS recall,
  SUM(tp) / SUM(support) AS f1, SUM(support)::BIGINT AS support FROM sc
  UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support)::BIGINT FROM sc
  UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
  SUM(f1 * support) / SUM(support), SUM(support)::BIGINT FROM sc"""


@query(
    "a21_class_report",
    over_bookings(
        f"""SELECT class, ROUND(precision, 9)::DOUBLE AS precision, ROUND(recall, 9)::DOUBLE AS recall,
        ROUND(f1, 9)::DOUBLE AS f1, support FROM
        (SELECT class, precision, recall, f1, support FROM sc UNION ALL {_AVERAGES})""",
        *_REPORT_CTES,
    ),
)
def class_report(spark, sf):
    report = metrics.class_report(predictions(spark, sf))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(
    "a22_weighted_scores",
    over_bookings(
        """SELECT ROUND(SUM(tp) / SUM(support), 9)::DOUBLE AS accuracy,
        ROUND(SUM(precision * support) / SUM(support), 9)::DOUBLE AS precision,
        ROUND(SUM(recall * support) / SUM(support), 9)::DOUBLE AS recall,
        ROUND(SUM(f1 * support) / SUM(support), 9)::DOUBLE AS f1 FROM sc""",
        *_REPORT_CTES,
    ),
)
def weighted_scores(spark, sf):
    scores = metrics.weighted_scores(predictions(spark, sf))
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])


_BOOKING_DRIFT = _ks_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, k % 2 = 0 AS is_ref FROM bookings WHERE {c} IS NOT NULL"
        for c in ("lead_time", "avg_price_per_room")
    )
)
_MONITOR_SQL = f"""SELECT 'data_drift' AS type, ROUND((SELECT 1 - AVG(p_value) FROM ks), 6)::DOUBLE AS score, 0.2::DOUBLE AS threshold
  UNION ALL SELECT 'model_drift', ROUND(ABS(AVG({_PREDICTED}) FILTER (WHERE k % 2 = 0)
    - AVG({_PREDICTED}) FILTER (WHERE k % 2 = 1)), 6)::DOUBLE, 0.1 FROM bookings
  UNION ALL SELECT 'prediction_accuracy', ROUND(AVG(({_PREDICTED} = {_LABEL})::INT), 6)::DOUBLE, 0.8
    FROM bookings WHERE k % 2 = 1"""


def _sides(spark, sf):
    df = predictions(spark, sf)
    return [df.filter(F.col("k") % 2 == side).drop("k") for side in (0, 1)]


@query("fs7_monitor_rows", over_bookings(_MONITOR_SQL, *_BOOKING_DRIFT))
def monitor_rows(spark, sf):
    rows = drift.monitor_rows(*_sides(spark, sf), RUN_TS)
    return rows.select("type", F.round("score", 6).alias("score"), "threshold")


@query(
    "s9_drift_log_append",
    over_bookings(f"SELECT type, score, threshold, 2::BIGINT AS n FROM ({_MONITOR_SQL})", *_BOOKING_DRIFT),
)
def drift_log(spark, sf):
    path = fresh_path(spark, "drift-log")
    for _ in range(2):
        monitor(*_sides(spark, sf), RUN_TS, path)
    log = spark.read.parquet(path)
    return log.groupBy("type", F.round("score", 6).alias("score"), "threshold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "st6_retrain_decision",
    over_bookings(
        f"""SELECT MAX(score) FILTER (WHERE type = 'data_drift') AS drift_score,
        MAX(score) FILTER (WHERE type = 'prediction_accuracy') AS accuracy,
        MAX(score) FILTER (WHERE type = 'data_drift') > 0.1
          OR MAX(score) FILTER (WHERE type = 'prediction_accuracy') < 0.8 AS retrain FROM ({_MONITOR_SQL})""",
        *_BOOKING_DRIFT,
    ),
)
def retrain(spark, sf):
    decision = monitor(*_sides(spark, sf), RUN_TS)
    return decision.select(F.round("drift_score", 6).alias("drift_score"), F.round("accuracy", 6).alias("accuracy"), "retrain")


_LATENCY = "value / 20"


@query(
    "a28_latency_histogram",
    " UNION ALL ".join(
        f"SELECT '{float(b)}' AS le, COUNT(*) FILTER (WHERE {_LATENCY} <= {b}) AS n FROM events"
        for b in metrics.LATENCY_BUCKETS
    )
    + " UNION ALL SELECT '+Inf', COUNT(value) FROM events",
)
def latency(spark, sf):
    df = table(spark, sf, "events").select((F.col("value") / 20).alias("duration"))
    return metrics.latency_histogram(df).select("le", "n")


@query("a27_request_count", "SELECT COUNT(*) AS n_requests FROM events WHERE event_type = 'click'")
def requests(spark, sf):
    return metrics.request_count(table(spark, sf, "events").filter("event_type = 'click'"))
