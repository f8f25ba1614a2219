"""Exact quantiles of whole columns and the outliers beyond them.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer. Here equal values
are counted with a combine before the shuffle, the counted values are dealt by range and ranked by
running totals, and each quantile is read off at its rank. One way for tables of every size; no task
holds more than its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.functions.columns import long_form
from lodgeworks.operators.ordering import grouped_quantiles, quantiles_of, ranked_values


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], buckets: int | None = None
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles, null and NaN left out; ``None`` for an empty column."""
    columns = list(dict.fromkeys(columns))
    found: dict[str, dict[float, float | None]] = {c: {p: None for p in probs} for c in columns}
    if columns:
        values = long_form(df, columns, "double")
        # One row per column.
        for row in grouped_quantiles(values, ["name"], "value", probs, buckets).collect():
            found[row["name"]] = {p: row[f"q{i}"] for i, p in enumerate(probs)}
    return found


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """``(column, q1, q3, n_outliers)`` per number column; strictly outside the fences.

    The ranked values give the quartiles and, being counted, the outliers too; the rows are read once.
    A column without values has no row.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, q1 double, q3 double, n_outliers long")
    ranked = ranked_values(long_form(df, columns, "double"), ["name"], "value")
    # One row per column.
    quartiles = F.broadcast(quantiles_of(ranked, ["name"], [0.25, 0.75]).select("name", F.col("q0").alias("q1"), F.col("q1").alias("q3")))
    reach = factor * (F.col("q3") - F.col("q1"))
    outside = (F.col("_v") < F.col("q1") - reach) | (F.col("_v") > F.col("q3") + reach)
    return ranked.join(quartiles, "name").groupBy(F.col("name").alias("column"), "q1", "q3").agg(
        F.coalesce(F.sum(F.when(outside, F.col("_n"))), F.lit(0)).cast("long").alias("n_outliers"))
