"""Data drift, model drift and their log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeworks.fields import DRIFT_THRESHOLDS, RETRAIN_ACCURACY, RETRAIN_DRIFT
from lodgeworks.functions.columns import long_form, number_columns
from lodgeworks.operators.metrics import accuracy
from lodgeworks.operators.ordering import running_totals
from lodgeworks.session import staged

LOG_SCHEMA = "ts timestamp_ntz, type string, score double, threshold double, details map<string,string>"
SERIES_TERMS = 100
#: Up to this size of both samples the p-value is exact.
EXACT_ROWS = 1_000


def exact_tail(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value of a two-sample statistic ``d``: the share of all orders of ``n`` and ``m`` values that reach it.

    An order is a lattice path. Step by step, an array holds for each number ``i`` of values of the first sample the
    chance that a random path gets there with all distances so far below ``d``; what remains at the end is the chance to
    stay below it. Distances are compared as whole numbers ``|i m - j n|``. The arrays have ``n + 1`` entries,
    the steps are ``n + m``; callers bound both by ``EXACT_ROWS``. Ties are not accounted for.
    """
    reach = F.round(d * n * m).cast("long")
    total = n + m

    def step(held: Column, k: Column) -> Column:
        left = (total - k + 1).cast("double")

        def chance(i: Column) -> Column:
            j = k - i
            from_first = F.coalesce(F.try_element_at(held, i.cast("int")), F.lit(0.0)) * (n - i + 1) / left
            from_second = F.try_element_at(held, (i + 1).cast("int")) * (m - j + 1) / left
            come = F.when(i == 0, 0.0).otherwise(from_first) + F.when(j == 0, 0.0).otherwise(from_second)
            return F.when((j >= 0) & (j <= m) & (F.abs(i * m - j * n) < reach), come).otherwise(0.0)

        return F.transform(F.sequence(F.lit(0).cast("long"), n), chance)

    start = F.transform(F.sequence(F.lit(0).cast("long"), n), lambda i: F.when(i == 0, 1.0).otherwise(0.0))
    below = F.aggregate(F.sequence(F.lit(1).cast("long"), total), start, step, lambda held: F.element_at(held, -1))
    return F.when(reach <= 0, F.lit(1.0)).otherwise(F.greatest(F.least(1 - below, F.lit(1.0)), F.lit(0.0)))


def kolmogorov_tail(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value of a two-sample statistic ``d`` with sample sizes ``n`` and ``m``.

    The limiting Kolmogorov series at the effective size ``n*m/(n+m)``, rounded, with the
    finite-size shift of the argument published by Vrbik (2018).
    """
    size = F.greatest(F.round(n * m / (n + m)), F.lit(1.0))
    base = d * F.sqrt(size)
    x = base + 1 / (6 * F.sqrt(size)) + (base - 1) / (4 * size)
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    tail = F.aggregate(
        terms,
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * x * x),
    )
    # Below this argument the tail is 1 to double precision and the series converges slowly.
    return F.when((d == 0) | (x < 0.2), F.lit(1.0)).otherwise(
        F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0))
    )


def two_sample_tail(d: Column, n: Column, m: Column) -> Column:
    """The exact p-value where both samples have at most ``EXACT_ROWS`` values, else the limiting series."""
    small = (n <= EXACT_ROWS) & (m <= EXACT_ROWS)
    # Large samples never reach the arrays.
    exact = exact_tail(d, F.when(small, n).otherwise(1), F.when(small, m).otherwise(1))
    return F.when(small, exact).otherwise(kolmogorov_tail(d, n, m))


def drift_columns(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """64-bit number columns of the reference, or ``columns``, that the current frame also has."""
    chosen = number_columns(reference) if columns is None else list(columns)
    have = set(current.columns)
    return [c for c in dict.fromkeys(chosen) if c in have]


def feature_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``(feature, n_ref, n_cur, d, p_value)``: the two-sample Kolmogorov-Smirnov test per column, exact for small samples.

    A feature without values on one side keeps its row, with a null statistic.

    Both sides are counted per (feature, value) with a combine before the shuffle, so ties and
    frequent values are one row each. Cumulative counts then come from bucketed running totals:
    no window over a whole feature, whatever its size.
    """
    names = drift_columns(reference, current, columns)
    if not names:
        return reference.sparkSession.createDataFrame(
            [], "feature string, n_ref long, n_cur long, d double, p_value double"
        )
    both = long_form(reference, names, "double").withColumn("_side", F.lit(0)).unionAll(
        long_form(current, names, "double").withColumn("_side", F.lit(1))
    )
    counts = staged(
        both.groupBy("name", "value").agg(
            F.count_if(F.col("_side") == 0).alias("ref"), F.count_if(F.col("_side") == 1).alias("cur")
        ),
        "drift",
    )
    steps = running_totals(counts, ["value"], ["ref", "cur"], ["name"], buckets, totals=True)
    gap = F.abs(F.col("ref_upto") / F.col("ref_total") - F.col("cur_upto") / F.col("cur_total"))
    both_sides = (F.col("ref_total") > 0) & (F.col("cur_total") > 0)
    tested = (
        steps.groupBy("name", F.col("ref_total").alias("n_ref"), F.col("cur_total").alias("n_cur"))
        .agg(F.max(F.when(both_sides, gap)).alias("d"))
        .select(
            F.col("name").alias("feature"), "n_ref", "n_cur", "d",
            F.when(F.col("d").isNotNull(), two_sample_tail(F.col("d"), F.col("n_ref"), F.col("n_cur"))).alias("p_value"),
        )
    )
    # A column empty on both sides has no values to count, but is still a row of the report.
    listed = reference.sparkSession.createDataFrame([(c,) for c in names], "feature string")
    return listed.join(tested, "feature", "left").select(
        "feature", F.coalesce("n_ref", F.lit(0)).alias("n_ref"), F.coalesce("n_cur", F.lit(0)).alias("n_cur"), "d", "p_value")


def data_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row ``score``: 1 minus the mean p-value; 1.0 when the frames share no column.

    Null when any compared column is empty on one side: that is missing data, not drift.
    """
    if not drift_columns(reference, current, columns):
        return reference.sparkSession.sql("SELECT 1.0D AS score")
    tested = feature_drift(reference, current, columns, buckets)
    return tested.agg(F.when(F.count("p_value") == F.count(F.lit(1)), 1 - F.avg("p_value")).alias("score"))


def model_drift(reference: DataFrame, current: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row ``score``: the distance between the mean predictions."""
    sides = reference.select(F.col(prediction).alias("r"), F.lit(None).cast("double").alias("c")).unionAll(
        current.select(F.lit(None).cast("double").alias("r"), F.col(prediction).alias("c"))
    )
    return sides.agg(F.abs(F.avg("r") - F.avg("c")).alias("score"))


def log_row(
    kind: str, score: Column, run_ts: str, threshold: float, method: str, details: dict[str, str] | None = None
) -> list[Column]:
    """One log record; ``details`` given by the caller stand beside the method, and a missing score says why."""
    known = [F.lit(x) for pair in {"method": method, **(details or {})}.items() for x in pair]
    reason = F.when(score.isNull(), F.create_map(F.lit("reason"), F.lit("no data on one side"))).otherwise(
        F.create_map().cast("map<string,string>"))
    return [
        F.lit(run_ts).cast("timestamp_ntz").alias("ts"),
        F.lit(kind).alias("type"),
        score.cast("double").alias("score"),
        F.lit(float(threshold)).alias("threshold"),
        F.map_concat(F.create_map(*known), reason).alias("details"),
    ]


def monitor_rows(
    reference: DataFrame, current: DataFrame, run_ts: str, *,
    prediction: str = "prediction", label: str = "label",
    columns: Sequence[str] | None = None, thresholds: dict[str, float] | None = None,
    details: dict[str, str] | None = None,
) -> DataFrame:
    """Three log rows with one schema: data drift, model drift and accuracy of the current frame.

    A score that cannot be computed for lack of data is null, and ``details`` of its row names the reason.
    """
    limits = {**DRIFT_THRESHOLDS, **(thresholds or {})}
    names = columns
    if names is None:
        names = [c for c in number_columns(reference) if c not in (prediction, label)]
    parts = [
        ("data_drift", data_drift(reference, current, names), "ks_2samp"),
        ("model_drift", model_drift(reference, current, prediction), "mean_diff"),
        ("prediction_accuracy",
         accuracy(current, label, prediction).withColumnRenamed("accuracy", "score"), "accuracy_score"),
    ]
    rows = None
    for kind, frame, method in parts:
        row = frame.select(*log_row(kind, F.col("score"), run_ts, limits[kind], method, details))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def retrain_decision(rows: DataFrame, drift: float = RETRAIN_DRIFT, floor: float = RETRAIN_ACCURACY) -> DataFrame:
    """One row: drift score, accuracy and whether to retrain."""
    scores = rows.agg(
        F.max(F.when(F.col("type") == "data_drift", F.col("score"))).alias("drift_score"),
        F.max(F.when(F.col("type") == "prediction_accuracy", F.col("score"))).alias("accuracy"),
    )
    return scores.withColumn(
        "retrain", F.coalesce((F.col("drift_score") > drift) | (F.col("accuracy") < floor), F.lit(False))
    )
