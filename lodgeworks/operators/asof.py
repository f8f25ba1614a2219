"""Point-in-time join with a time-to-live.

Spine and features are merged in one stream ordered by key and time, and the newest feature row so
far is carried to each spine row: no row multiplication, any number of feature views. The stream is
dealt by range of (key, time), so a key with any share of the rows spreads over as many ranges as
its rows ask for, and no key needs to be known beforehand. A key that reaches into a range from
an earlier one brings its last feature row along.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeworks.session import staged


@dataclass(frozen=True)
class FeatureSet:
    """Feature rows for an as-of join. ``created`` orders rows of equal time, newest wins; ``names`` replaces the names of the fields."""

    df: DataFrame
    fields: tuple[str, ...]
    ts: str
    ttl: timedelta | None = None
    created: str | None = None
    prefix: str = ""
    names: tuple[str, ...] | None = None

    def rows(self, keys: Sequence[str], index: int) -> DataFrame:
        """Keys, ``_ts``, ``_created`` and the fields in one struct ``_row{index}``."""
        created = F.col(self.created).cast("timestamp_ntz") if self.created else F.lit(None).cast("timestamp_ntz")
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        return self.df.filter(known & F.col(self.ts).isNotNull()).select(
            *keys,
            F.col(self.ts).alias("_ts"),
            created.alias("_created"),
            F.xxhash64(*self.fields).alias("_tie"),
            F.struct(F.col(self.ts).alias("_at"), *self.fields).alias(f"_row{index}"),
        )

    def outputs(self, index: int, spine_ts: Column) -> list[Column]:
        row = F.col(f"_row{index}")
        fresh = row.isNotNull()
        if self.ttl is not None:
            fresh = fresh & (row["_at"] >= spine_ts - _interval(self.ttl))
        return [F.when(fresh, row[f]).alias(self.prefix + n) for f, n in zip(self.fields, self.names or self.fields)]


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(F.lit(span.days), F.lit(0), F.lit(0),
                              F.lit(span.seconds + span.microseconds / 1e6).cast("decimal(18,6)"))


def as_of_join(
    spine: DataFrame,
    features: FeatureSet | Sequence[FeatureSet],
    keys: Sequence[str],
    ts: str,
    ranges: int | None = None,
) -> DataFrame:
    """Each spine row with the newest feature row at or before its time and within the TTL.

    Every spine row is kept, copies included; without a match the fields are null. An expired
    newest row gives null, not an older row. Of rows of equal time the newest created one counts, then the
    one of the largest hash of its fields, whatever the partitions. The number of ranges follows the size of the rows
    unless ``ranges`` sets it. The dealt rows are staged once, because the bounds of the ranges come
    from a sample and a second evaluation could cut elsewhere.
    """
    views = [features] if isinstance(features, FeatureSet) else list(features)
    keys = list(keys)
    rest = [c for c in spine.columns if c not in (*keys, ts)]
    merged = spine.select(
        *keys, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast("timestamp_ntz").alias("_created"),
        F.lit(None).cast("long").alias("_tie"), F.struct(*rest, F.lit(1).alias("_any")).alias("_rest"),
    )
    for i, view in enumerate(views):
        merged = merged.unionByName(view.rows(keys, i).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    order = ["_ts", "_side", "_created", "_tie"]
    dealt = merged.repartitionByRange(*([ranges] if ranges else []), *keys, *order)
    dealt = staged(dealt.withColumn("_range", F.spark_partition_id()), "as-of")

    so_far = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = [f"_row{i}" for i in range(len(views))]
    carried = dealt.withColumns({r: F.last(r, ignorenulls=True).over(so_far) for r in rows}).filter("_side = 1")
    return _finish(_with_earlier(carried, dealt, rows, keys), spine, views, keys, ts)


def _with_earlier(carried: DataFrame, dealt: DataFrame, rows: list[str], keys: list[str]) -> DataFrame:
    """Where a range has no feature row of a key up to a spine row: the last one of the ranges before it."""
    newest = [F.max_by(r, F.when(F.col(r).isNotNull(), F.struct("_ts", "_created", "_tie"))).alias(r) for r in rows]
    every = Window.partitionBy(*keys)
    earlier = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy("_range", *keys).agg(*newest).select(
        F.col("_range").alias("_r"),
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.last(r, ignorenulls=True).over(earlier).alias(f"_earlier{r}") for r in rows],
        F.count(F.lit(1)).over(every).alias("_ranges"),
    ).filter("_ranges > 1")
    match = F.col("_range") == F.col("_r")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    # Of each range at most its first and its last key reach beyond it, so two rows per range.
    joined = carried.join(F.broadcast(ends), match, "left")
    return joined.withColumns({r: F.coalesce(r, f"_earlier{r}") for r in rows})


def _finish(carried, spine, views, keys, ts) -> DataFrame:
    outs = [c for i, v in enumerate(views) for c in v.outputs(i, F.col("_ts"))]
    kept = [
        F.col(c) if c in keys else F.col("_ts").alias(ts) if c == ts else F.col(f"_rest.{c}").alias(c)
        for c in spine.columns
    ]
    return carried.select(*kept, *outs)


def latest_by_key(
    df: DataFrame, keys: Sequence[str], ts: str, created: str | None = None
) -> DataFrame:
    """The newest row per key; combined before the shuffle, so a heavy key is one row per task.

    Of equal times the newest created row counts, then that of the largest hash, so partitions and order do not matter.
    """
    rest = [c for c in df.columns if c not in keys]
    hashed = [c for c in rest if not df.schema[c].dataType.simpleString().startswith(("map", "variant"))]
    order = [F.col(ts)] + ([F.col(created)] if created else []) + [F.xxhash64(*[F.col(f"`{c}`") for c in hashed])]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
