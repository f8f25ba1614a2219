"""Classification metrics and request metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.fields import LATENCY_BUCKETS


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted averages.

    One aggregation over the rows; the rest works on the (label, prediction) counts. Undefined
    ratios are 0.
    """
    cells = confusion(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), zero.alias("given"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), F.col("n").alias("given"), zero.alias("tp")),
    )
    per_class = (
        cells.select(F.explode(sides).alias("_s"))
        .select("_s.*")
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "given", "tp")])
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = per_class.withColumns(
        {"precision": ratio(F.col("tp"), F.col("given")), "recall": ratio(F.col("tp"), F.col("support"))}
    ).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    names = ("precision", "recall", "f1")
    share = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    summary = scored.agg(
        F.sum("support").alias("total"),
        ratio(F.sum("tp"), F.sum("support")).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[share(c).alias(f"w_{c}") for c in names],
    )
    row = lambda title, p, r, f: F.struct(
        F.lit(title).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
        F.col("total").alias("support"),
    )
    averages = summary.select(
        F.explode(
            F.array(
                row("accuracy", F.col("acc"), F.col("acc"), F.col("acc")),
                row("macro avg", *[F.col(f"m_{c}") for c in names]),
                row("weighted avg", *[F.col(f"w_{c}") for c in names]),
            )
        ).alias("_a")
    ).select("_a.*")
    return scored.select("class", *names, "support").unionByName(averages)


def weighted_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and the support-weighted precision, recall and F1."""
    report = class_report(df, label, prediction)
    pick = lambda title, c: F.max(F.when(F.col("class") == title, F.col(c)))
    return report.agg(
        pick("accuracy", "precision").alias("accuracy"),
        pick("weighted avg", "precision").alias("precision"),
        pick("weighted avg", "recall").alias("recall"),
        pick("weighted avg", "f1").alias("f1"),
    )


def latency_histogram(
    df: DataFrame, duration: str = "duration", bounds: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Cumulative bucket counts as rows ``(le, n)``, with total count and sum on every row."""
    totals = df.agg(
        F.count(duration).alias("total"),
        F.coalesce(F.sum(duration), F.lit(0.0)).alias("total_seconds"),
        *[F.count_if(F.col(duration) <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
    )
    cells = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)
    ] + [F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("n"))]
    return totals.select(F.explode(F.array(*cells)).alias("_b"), "total", "total_seconds").select(
        "_b.le", "_b.n", "total", "total_seconds"
    )


def request_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_requests"))
