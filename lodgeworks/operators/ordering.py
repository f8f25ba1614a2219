"""Running totals, contiguous numbers and grouped quantiles over a global order.

A window over the whole table runs in one task. Here the rows are dealt by range of the order, each
partition is one window partition, and what the partitions before it add up to is carried in from
a table of at most two rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeworks.session import staged


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    group: Sequence[str] = (),
    buckets: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """Add ``{name}_upto`` for each of ``sums``: its total up to and including the row, per group.

    With ``totals``, also ``{name}_total``: its total over the group. ``df`` should hold one row per
    (group, order): aggregate first, so that a frequent value is one row here. Groups are not
    partitions of their own, so a group of any size is spread over ranges. The number of ranges
    follows the size of the rows, unless ``buckets`` sets it. The dealt rows are staged once with the
    number of their range: its bounds come from a sample, and a second evaluation could cut elsewhere.
    """
    group, order, sums = list(group), list(order), list(sums)
    names = df.columns
    dealt = df.repartitionByRange(*([buckets] if buckets else []), *group, *order)
    df = staged(dealt.withColumn("_bucket", F.spark_partition_id()), "ranges")

    part = Window.partitionBy("_bucket", *group)
    upto = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {f"{s}_upto": F.sum(s).over(upto) for s in sums}
    if totals:
        added.update({f"{s}_total": F.sum(s).over(part) for s in sums})
    # One row per range and group; only a group that reaches over several ranges carries anything.
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.groupBy("_bucket", *group)
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            F.col("_bucket").alias("_b"),
            *[F.col(g).alias(f"_g_{g}") for g in group],
            *[F.sum(s).over(before).alias(f"_before_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"_whole_{s}") for s in sums],
            F.count(F.lit(1)).over(whole).alias("_ranges"),
        )
        .filter("_ranges > 1")
    )
    match = (F.col("_bucket") == F.col("_b")) & _null_safe(group, "_g_")
    # Of each range at most its first and its last group, so two rows per range.
    joined = df.withColumns(added).join(F.broadcast(carry), match, "left")
    final = {f"{s}_upto": F.col(f"{s}_upto") + F.coalesce(f"_before_{s}", F.lit(0)) for s in sums}
    if totals:
        final.update({f"{s}_total": F.coalesce(f"_whole_{s}", f"{s}_total") for s in sums})
    return joined.withColumns(final).select(*names, *added)


def _null_safe(group: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(prefix + g))
    return same


def number_rows(
    df: DataFrame, keys: Sequence[str], name: str = "booking_id", start: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Contiguous numbers from ``start`` in the order of ``keys``.

    Rows with equal keys get numbers of their own, in the order of the input; many of them spread
    over several ranges.
    """
    numbered = running_totals(
        df.withColumns({"_one": F.lit(1).cast("long"), "_tie": F.monotonically_increasing_id()}),
        [*keys, "_tie"], ["_one"], buckets=buckets,
    )
    return numbered.withColumn(name, F.col("_one_upto") + (start - 1)).drop("_one", "_one_upto", "_tie")


def ranked_values(df: DataFrame, group: Sequence[str], value: str, buckets: int | None = None) -> DataFrame:
    """Each distinct value ``_v`` of a group with its count ``_n``, the count up to it ``_n_upto`` and the group's ``n``."""
    counts = (
        df.select(*group, F.col(value).cast("double").alias("_v"))
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*group, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_totals(counts, ["_v"], ["_n"], group, buckets, totals=True).withColumnRenamed("_n_total", "n")
    return staged(ranked, "ranked")


def quantiles_of(ranked: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``group`` columns, ``n`` and one column ``q0, q1, ...`` per probability; exact, interpolated."""
    group = list(group)
    upto, start = F.col("_n_upto"), F.col("_n_upto") - F.col("_n")
    aggs = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        for tag, rank in (("a", F.floor(place)), ("b", F.ceil(place))):
            aggs.append(F.max(F.when((start <= rank) & (rank < upto), F.col("_v"))).alias(f"_{tag}{i}"))
    folded = ranked.groupBy(*group, "n").agg(*aggs)
    outs = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        outs.append((a + (b - a) * (place - F.floor(place))).alias(f"q{i}"))
    return folded.select(*group, "n", *outs)


def grouped_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
    buckets: int | None = None,
) -> DataFrame:
    """Quantiles of ``value`` per group: equal values are counted first, so frequent ones are one row."""
    return quantiles_of(ranked_values(df, group, value, buckets), group, probs)
