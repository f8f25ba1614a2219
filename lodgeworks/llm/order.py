"""A global order with exclusive prefix sums, from per-partition totals."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lodgeworks.session import staged

#: Names that the helpers add; a caller's columns of these names are replaced.
SIZE, PART, ROW, BEFORE, TOTAL, TIE = "__lw_size", "__lw_part", "__lw_row", "__lw_before", "__lw_total", "__lw_tie"


@F.pandas_udf(LongType())
def _running(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
    total = 0
    for batch in sizes:
        sums = batch.cumsum() + total
        total = int(sums.iloc[-1]) if len(sums) else total
        yield sums


def dealt_in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` dealt by range of ``keys`` and sorted, with the partition ``__lw_part`` and the row number in it, ``__lw_row``.

    Nulls come first; equal keys keep the order of the input and may lie in several partitions. Write
    the result before using it twice: the bounds of a range shuffle come from a sample, and a second
    evaluation may cut elsewhere.
    """
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col(TIE).asc()]
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    sorted_parts = tied.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_parts.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(ROW),
    )


def ordered_parts(df: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """``dealt_in_order`` with ``__lw_size`` and ``__lw_before``, the bytes before the row in its partition.

    Only the size travels to Python.
    """
    rows = dealt_in_order(df.withColumn(SIZE, size.cast("long")), keys)
    return rows.withColumn(BEFORE, _running.asNondeterministic()(SIZE) - F.col(SIZE))


def with_offsets(rows: DataFrame) -> DataFrame:
    """Written ``ordered_parts`` with the row number and the bytes before over all partitions, and ``__lw_total``.

    The only state between partitions is one total each.
    """
    totals = rows.groupBy(PART).agg(F.sum(SIZE).alias("__lw_bytes"), F.count(F.lit(1)).alias("__lw_rows"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PART,
        F.coalesce(F.sum("__lw_bytes").over(earlier), F.lit(0)).alias("__lw_bytes_before"),
        F.coalesce(F.sum("__lw_rows").over(earlier), F.lit(0)).alias("__lw_rows_before"),
        F.sum("__lw_bytes").over(Window.partitionBy()).alias(TOTAL),
    )
    return (
        rows.join(F.broadcast(offsets), PART)  # one row per range partition
        .withColumn(ROW, F.col(ROW) + F.col("__lw_rows_before"))
        .withColumn(BEFORE, F.col(BEFORE) + F.col("__lw_bytes_before"))
        .drop("__lw_rows_before", "__lw_bytes_before")
    )


def with_prefix_sums(df: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """``df`` in the global order of ``keys`` with its row number, size, bytes before and the total."""
    return with_offsets(staged(ordered_parts(df, keys, size), "ordered"))
