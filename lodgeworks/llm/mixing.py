"""Sources interleaved to target weights by Pfair windows and earliest-deadline-first."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lodgeworks.session import fresh_path

#: Slots of the schedule that the driver holds at a time.
CHUNK = 1 << 18


def schedule(weights: list, blocks: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Source number, block, release and deadline of every slot in turn, for sources of ``weights`` with so many ``blocks``.

    The ideal mix gives each source its exact share of every slot; once a source has ended, the others
    share its slots in proportion. Block ``j`` is released in the slot in which the ideal begins it and due
    when the ideal has ended it. Slot by slot, the released block with the earliest deadline is taken.
    The ideal itself fits these windows, so earliest deadline first does too, and no source is ever a
    block or more before or behind its exact share, at any length. All numbers are whole; nothing is rounded.
    """
    if any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("positive finite weights are needed")
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    share = [int(w * scale) for w in exact]
    # In the order in which the ideal ends them: blocks ended before, and the weight that remains.
    ends = sorted(range(len(share)), key=lambda s: Fraction(blocks[s], share[s]))
    at = [blocks[s] / float(exact[s]) for s in ends]
    ended, left = [0], [sum(share)]
    for s in ends:
        ended.append(ended[-1] + blocks[s])
        left.append(left[-1] - share[s])

    def window(s: int, j: int) -> tuple[int, int]:
        """Floor of the time at which the ideal has given ``j`` blocks to ``s``, and ceiling of that for ``j + 1``."""
        times = []
        for n in (j, j + 1):
            # The quotient of floats finds the place, whole numbers settle it.
            i = bisect_right(at, n / float(exact[s]))
            while i < len(ends) and blocks[ends[i]] * share[s] <= n * share[ends[i]]:
                i += 1
            while i > 0 and blocks[ends[i - 1]] * share[s] > n * share[ends[i - 1]]:
                i -= 1
            times.append((ended[i], left[i] * n))
        (a, x), (b, y) = times
        return a + x // share[s], b - (-y // share[s])

    waiting = [(*window(s, 0), s, 0) for s in range(len(share)) if blocks[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            release, due, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, j, release))
        due, s, j, release = heapq.heappop(ready)
        yield s, j, release, due
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (*window(s, j + 1), s, j + 1))


def schedule_table(spark: SparkSession, weights: list, blocks: list[int], frame: int) -> DataFrame:
    """The schedule with a row per slot: ``__lw_slot_s``, ``__lw_slot_j``, ``__lw_released``, ``__lw_due`` and ``__lw_at``.

    The driver makes it in turn and hands over ``CHUNK`` slots at a time to the shared folder, a row per
    ``frame`` slots; it keeps no more than one chunk and one block per source.
    """
    path, slots, total = fresh_path(spark, "schedule"), schedule(weights, blocks), sum(blocks)
    kind = "first long, s array<long>, j array<long>, released array<long>, due array<long>"
    for start in range(0, total, CHUNK):
        rows = []
        for first in range(start, min(total, start + CHUNK), frame):
            size = min(frame, total - first, start + CHUNK - first)
            rows.append((first, *(list(c) for c in zip(*(next(slots) for _ in range(size))))))
        part = pd.DataFrame(rows, columns=["first", "s", "j", "released", "due"])
        spark.createDataFrame(part, kind).write.mode("append").parquet(path)
    packed = spark.read.schema(kind).parquet(path)
    return packed.select("first", F.posexplode(F.arrays_zip("s", "j", "released", "due")).alias("i", "p")).select(
        F.col("p.s").alias("__lw_slot_s"), F.col("p.j").alias("__lw_slot_j"), F.col("p.released").alias("__lw_released"),
        F.col("p.due").alias("__lw_due"), (F.col("first") + F.col("i")).alias("__lw_at"))


def mix_sources(
    docs: DataFrame,
    weights: dict | None = None,
    *,
    source: str = "source",
    key: str = "doc_id",
    tempering: float = 0.5,
    block_rows: int = 16,
    frame: int = 1000,
    bucket_rows: int = 2_000,
) -> DataFrame:
    """``docs`` with their place in one sequence that follows the target weights from its first block on.

    ``weights`` maps each source to its share; without it, shares follow the row counts raised to
    ``tempering``. Every ``block_rows`` documents of a source form a block. Adds ``block`` (its number in
    the source), ``release`` and ``deadline`` (the slots between which it may stand), ``slot`` (where it
    stands; the sequence has no gaps) and ``rank`` (the document's place in its block). All documents
    are kept: once a source has ended, the others share its slots in their own proportion.

    Per source and bucket of a key hash one row count is kept, so a source with most of the rows
    spreads over as many tasks as its rows ask for. Order within a source is by that hash. The
    driver holds one count and one weight per source, and makes the schedule of the blocks in turn;
    ``frame`` is the number of slots in a row of it and has no influence on the result.

    A null source is a source of its own; a null key is a key like others; equal keys and repeated
    rows are ordered by an additional hash of the row and each keeps a place of its own; empty
    tables give empty results; columns with the names added are replaced. A source without a
    given weight raises ValueError.
    """
    spark = docs.sparkSession
    added = ["block", "release", "deadline", "slot", "rank"]
    plain = docs.drop(*added)
    tagged = plain.withColumns({"__lw_h": F.xxhash64(F.col(key)), "__lw_null": F.col(source).isNull()})
    counts = {r[0]: r[1] for r in plain.groupBy(source).agg(F.count(F.lit(1))).collect()}
    if not counts:
        return plain.select("*", *[F.lit(None).cast("long").alias(c) for c in added])
    if weights is None:
        weights = {s: n**tempering for s, n in counts.items()}
    if missing := [s for s in counts if s not in weights]:
        raise ValueError(f"no weight for {missing}")
    sources = sorted(counts, key=lambda s: (s is not None, str(s)))
    blocks = [-(-counts[s] // block_rows) for s in sources]
    slots = schedule_table(spark, [weights[s] for s in sources], blocks, frame)
    kind = StructType([StructField("__lw_s", LongType()), StructField("__lw_n_source", plain.schema[source].dataType)])
    numbers = spark.createDataFrame(list(enumerate(sources)), kind)

    buckets = max(1, sum(counts.values()) // bucket_rows)
    placed = tagged.withColumn("__lw_bucket", F.pmod(F.col("__lw_h"), F.lit(buckets)))
    sizes = placed.groupBy(source, "__lw_null", "__lw_bucket").agg(F.count(F.lit(1)).alias("__lw_n"))
    earlier = Window.partitionBy(source).orderBy("__lw_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(numbers, F.col(source).eqNullSafe(F.col("__lw_n_source"))).select(
        "__lw_s",
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__lw_o_source"),
        F.col("__lw_null").alias("__lw_o_null"),
        F.col("__lw_bucket").alias("__lw_o_bucket"),
        F.coalesce(F.sum("__lw_n").over(earlier), F.lit(0)).alias("__lw_skip"),
    )
    in_bucket = Window.partitionBy(source, "__lw_bucket").orderBy("__lw_h", key, *_tie(plain, source, key))
    numbered = placed.withColumn("__lw_i", F.row_number().over(in_bucket) - 1)
    # One row per source and bucket; adaptive execution decides how to join it.
    joined = numbered.join(
        offsets,
        (F.coalesce(F.col(source).cast("string"), F.lit("")) == F.col("__lw_o_source"))
        & (F.col("__lw_null") == F.col("__lw_o_null"))
        & (F.col("__lw_bucket") == F.col("__lw_o_bucket")),
    ).withColumn("__lw_i", F.col("__lw_i") + F.col("__lw_skip"))

    rows = joined.withColumns({
        "block": F.floor(F.col("__lw_i") / block_rows).cast("long"), "rank": (F.col("__lw_i") % block_rows).cast("long"),
    })
    # A source with most of the rows is dealt by its blocks.
    out = rows.join(slots, (F.col("__lw_s") == F.col("__lw_slot_s")) & (rows["block"] == F.col("__lw_slot_j")))
    return out.select(
        *[rows[f"`{c}`"] for c in plain.columns],
        rows["block"],
        F.col("__lw_released").alias("release"),
        F.col("__lw_due").alias("deadline"),
        F.col("__lw_at").alias("slot"),
        rows["rank"],
    )


def _tie(plain: DataFrame, source: str, key: str) -> list[Column]:
    """A hash of the other columns, in which equal keys differ unless the rows are the same."""
    rest = [c for c, kind in plain.dtypes if c not in (source, key) and not kind.startswith(("map", "variant"))]
    return [F.xxhash64(*[F.col(f"`{c}`") for c in rest])] if rest else []


def in_mixed_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The documents dealt and sorted by their place, so that files in name order hold the sequence."""
    order = [F.col("slot"), F.col("rank")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in columns])
