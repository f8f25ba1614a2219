"""Quantiles and drift from KLL sketches, which are merged without reading the rows again.

A sketch has a few kilobytes whatever the rows, so it is kept per batch, day or partition and merged for any span.
Its answers are approximate: a returned value's rank is off by at most ``error`` (a share of the rows) with about 99 %
confidence. Exact quantiles are in ``quantiles``; these are the choice for data too large to rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgeworks.functions.columns import long_form
from lodgeworks.operators.drift import two_sample_tail

#: Size parameter; larger sketches have smaller errors.
K = 400
#: Points at which two sketches are compared.
GRID = 400


def rank_error(k: int = K) -> float:
    """The published bound of the rank error of one sketch of size ``k``, as a share of the rows."""
    return 2.296 / k**0.9723


def sketch(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``(*by, name, n, sketch)``: one sketch per column and group; nulls and NaN are left out.

    Tasks build partial sketches before the shuffle. A column without values has no row.
    """
    values = long_form(df, columns, "double", list(by)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return values.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merge(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Sketches (``name``, ``n``, ``sketch``) added up per name and group; the rows behind them are not read."""
    return sketches.groupBy(*by, "name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float], k: int = K) -> DataFrame:
    """``name``, ``n``, one column ``q0, q1, ...`` per probability and ``error``."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)]
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, *found, F.lit(rank_error(k)).alias("error"))


def _values_at(sketch_: str) -> Column:
    return F.kll_sketch_get_quantile_double(sketch_, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))


def sketched_drift(reference: DataFrame, current: DataFrame, k: int = K) -> DataFrame:
    """``(feature, n_ref, n_cur, d, p_value, error)``: the largest distance of the two distributions, from sketches alone.

    Each side is read off at ``GRID`` equal shares, and the shares up to any of these values are compared; ``error`` bounds how far
    ``d`` is from the exact statistic: the error of a sketch and one step of the grid, for both sides. A feature that one side
    lacks has null ``d``.
    """
    both = reference.select("name", F.col("n").alias("n_ref"), F.col("sketch").alias("r")).join(
        current.select("name", F.col("n").alias("n_cur"), F.col("sketch").alias("c")), "name", "full")
    known = F.col("r").isNotNull() & F.col("c").isNotNull()
    sides = both.filter(known).select("name", _values_at("r").alias("a"), _values_at("c").alias("b"))
    # One walk over all values in order; of equal values all are counted before the gap is taken.
    marked = F.array_sort(F.concat(F.transform("a", lambda v: F.struct(v.alias("v"), F.lit(1).alias("s"))),
                                   F.transform("b", lambda v: F.struct(v.alias("v"), F.lit(-1).alias("s")))))
    walked = F.aggregate(
        marked, F.struct(F.lit(None).cast("double").alias("v"), F.lit(0).alias("gap"), F.lit(0).alias("most")),
        lambda acc, x: F.struct(
            x["v"].alias("v"), (acc["gap"] + x["s"]).alias("gap"),
            F.when(acc["v"] < x["v"], F.greatest(acc["most"], F.abs(acc["gap"]))).otherwise(acc["most"]).alias("most")),
        lambda acc: F.greatest(acc["most"], F.abs(acc["gap"])) / (GRID + 1))
    tested = both.select("name", "n_ref", "n_cur").join(sides.select("name", walked.alias("d")), "name", "left")
    return tested.select(
        F.col("name").alias("feature"), F.coalesce("n_ref", F.lit(0)).alias("n_ref"), F.coalesce("n_cur", F.lit(0)).alias("n_cur"), "d",
        F.when(F.col("d").isNotNull(), two_sample_tail(F.col("d"), F.col("n_ref"), F.col("n_cur"))).alias("p_value"),
        F.lit(2 * (rank_error(k) + 1 / GRID)).alias("error"))


def sketch_stream(
    stream: DataFrame, columns: Sequence[str], path: str, checkpoint: str, k: int = K, available_now: bool = True,
) -> StreamingQuery:
    """One sketch per column and batch, written under the batch's number; a replay overwrites its own."""

    def write(batch: DataFrame, number: int) -> None:
        sketch(batch, columns, k=k).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def streamed_sketches(spark: SparkSession, path: str, first: int = 0, last: int | None = None, k: int = K) -> DataFrame:
    """The sketches of the batches ``first`` to ``last`` merged."""
    rows = spark.read.parquet(path).filter(F.col("batch") >= first)
    return merge(rows if last is None else rows.filter(F.col("batch") <= last), k=k)
