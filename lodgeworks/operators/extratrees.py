"""Feature importance from extremely randomised trees, all trees of a level in two passes.

A node draws a few features and, for each, one threshold between the least and the largest value of its rows;
the draw is a hash of (tree, node, feature), so it does not depend on partitions or order. The rows stay where they
are and carry the number of their node in every tree; a pass adds up, per node, what the draw and then the choice
among the drawn splits need. Depth has no limit: nodes are rows of arrays, not of a tree in a library.
Rows are read by the block, one array per feature and per tree. Trees grow in groups, so that the numbers of the nodes
that stand with the rows stay a bounded share of them; a group's files go when the next ones are written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.session import discard, staged

#: A node with fewer rows, or with a smaller share of all rows, stays a leaf; so a level has a bounded number of nodes.
LEAST_ROWS, LEAST_SHARE = 2, 1e-4
#: Bytes of sums that one pass gathers from a task.
PASS_BYTES = 1 << 22
#: Levels after which the rows are written with their nodes.
CUT_LEVELS = 4
TASK_ROWS = 4_000
#: Rows of a block, blocks of a file, and rows beyond which the cores have several tasks each.
BLOCK_ROWS, FILE_BLOCKS, MOST_ROWS = 5_000, 16, 1 << 20
#: Rows times trees that grow together.
HAND = 1 << 28
#: Tables of so many tasks are put together on the driver; those of more are put together by salt first.
DIRECT_TASKS = 16


def draws(seed: int, tree: np.ndarray, node: np.ndarray, feature: np.ndarray, use: int) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on the arguments alone."""
    mixed = np.full(np.broadcast(tree, node, feature).shape, (seed * 4 + use) % 2**64, dtype=np.uint64)
    for part in (tree, node, feature):
        mixed = (mixed ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2**53


@dataclass
class Level:
    """The chosen splits of a level: per tree and slot the feature (-1: a leaf), the threshold and the slots of the right and the left
    child in turn (-1: leaves, and both of a leaf)."""

    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    sides: np.ndarray


def _moved(x: np.ndarray, slots: np.ndarray, levels: list[Level], trees: Sequence[int]) -> np.ndarray:
    """The slot of every row in every one of ``trees`` (by tree) after the splits of ``levels``; those of other trees stay as they are."""
    flat, n = x.ravel(), x.shape[1]
    for level in levels:
        # At a leaf both sides are -1, whatever value is read there.
        shift = level.feature * n
        for t in trees:
            slot = slots[t]
            rows = np.flatnonzero(slot >= 0)
            at = slot[rows] + level.start[t]
            goes = flat.take(shift.take(at) + rows) <= level.cut.take(at)
            slot[rows] = level.sides.take(2 * at + goes)
    return slots


_BLOCK = "rows int, y binary, n binary, x binary, slots binary"


def _opened(block: Any, width: int, trees: int, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values by feature, slots by tree, labels and weights of a block; without slots all rows are in the roots."""
    rows = block["rows"]
    slots = np.frombuffer(block["slots"], dtype=kind).reshape(trees, rows).copy() if block["slots"] else np.zeros((trees, rows), dtype=kind)
    return (np.frombuffer(block["x"], dtype=np.float64).reshape(width, rows), slots,
            np.frombuffer(block["y"], dtype=np.float64).astype(np.int64), np.frombuffer(block["n"], dtype=np.float64))


@dataclass
class Blocks:
    """The rows while a group of trees grows: the frame and its rows dealt to ``tasks``; ``kind`` holds the number of any open node."""

    frame: DataFrame
    tasks: int
    width: int
    trees: int
    kind: type
    pending: list = field(default_factory=list)  # levels since the rows were written

    def __post_init__(self) -> None:
        self.rows: RDD = self.frame.rdd.coalesce(self.tasks)

    def gathered(self, used: Sequence[int], fn: Callable, fold: Callable) -> np.ndarray:
        """``fn`` adds all blocks of a task to one array; ``fold`` puts two together. Only the trees ``used`` are moved."""
        width, trees, kind, pending = self.width, self.trees, self.kind, self.pending

        def run(task: int, blocks: Iterator[Any]) -> Iterator[tuple[int, np.ndarray]]:
            held, levels = None, [p.value for p in pending]
            for block in blocks:
                x, slots, y, n = _opened(block, width, trees, kind)
                held = fn(held, x, _moved(x, slots, levels, used), y, n)
            if held is not None:
                yield task % DIRECT_TASKS, held

        parts = self.rows.mapPartitionsWithIndex(run)
        if self.rows.getNumPartitions() > DIRECT_TASKS:
            parts = parts.reduceByKey(fold, DIRECT_TASKS)
        held = None
        for _, now in parts.collect():  # at most DIRECT_TASKS times PASS_BYTES
            held = now if held is None else fold(held, now)
        return held

    def written(self) -> Blocks:
        """The same rows with the slots after all pending levels."""
        width, trees, kind, pending = self.width, self.trees, self.kind, self.pending

        def move(blocks: Iterator[Any]) -> Iterator[tuple]:
            levels = [p.value for p in pending]
            for block in blocks:
                x, slots, _, _ = _opened(block, width, trees, kind)
                yield block["rows"], block["y"], block["n"], block["x"], bytearray(_moved(x, slots, levels, range(trees)).tobytes())

        moved = self.frame.sparkSession.createDataFrame(self.rows.mapPartitions(move), _BLOCK, verifySchema=False)
        return Blocks(staged(moved, "trees", FILE_BLOCKS), self.tasks, width, trees, kind)


def extra_trees_importance(
    df: DataFrame, columns: Sequence[str], label: str = "label", trees: int = 100, seed: int = 42, depth: int | None = None,
    tried: int | None = None, least_rows: int = LEAST_ROWS, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``(feature, importance)``: the decrease of the Gini impurity by the splits on each feature, per tree shares, averaged; sums to 1.

    Every tree sees all rows. A node tries ``tried`` features (default: the square root of their number, rounded down); where all
    of them are constant it draws as many more, until none is left. Nodes split until they are pure, at ``depth`` (default: never), or
    below ``least_rows`` rows or ``least_share`` of all rows (2 rows up to 20,000 rows). Equal rows count as one with a weight.
    The label is 0 / 1; a null or NaN raises ValueError. Without any split all importances are 0.
    """
    names = [f"`{c}`" for c in columns]
    width = len(columns)
    tried = tried or max(1, math.isqrt(width))
    cells = df.select(F.array(*[F.col(c).cast("double") for c in names]).alias("v"), F.col(label).cast("double").alias("y"))
    cells = staged(cells.groupBy("v", "y").agg(F.count(F.lit(1)).cast("double").alias("n")), "cells")
    size = cells.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.sum(F.col("y") * F.col("n")).alias("ones"),
                     F.count_if(F.exists("v", lambda v: v.isNull() | F.isnan(v)) | ~F.col("y").isin(0.0, 1.0) | F.col("y").isNull()).alias("bad")).first()
    if not size["rows"]:
        raise ValueError("the frame has no rows")
    if size["bad"]:
        raise ValueError("null or other values that a tree cannot use")
    total = size["n"]
    least = max(least_rows, least_share * total)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-size["rows"] // TASK_ROWS), cores * -(-size["rows"] // (cores * MOST_ROWS))))
    groups = np.array_split(np.arange(trees), max(1, min(trees, -(-size["rows"] * trees // HAND))))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for at in range(0, len(part), BLOCK_ROWS):
                some = part.iloc[at : at + BLOCK_ROWS]
                x = np.ascontiguousarray(np.array(some["v"].tolist(), dtype=np.float64).T)
                yield pd.DataFrame({"rows": [len(some)], "y": [some["y"].to_numpy(np.float64).tobytes()], "n": [some["n"].to_numpy(np.float64).tobytes()],
                                    "x": [x.tobytes()], "slots": [b""]})

    rows = staged(cells.repartition(tasks).mapInPandas(pack, _BLOCK), "trees", FILE_BLOCKS)
    discard(cells)
    # A level has at most total / least nodes.
    kind = np.int16 if total / least < np.iinfo(np.int16).max else np.int32
    counts = np.array([total - size["ones"], size["ones"]])
    gains = np.concatenate([_grown(Blocks(rows, tasks, width, len(g), kind), g, counts, tried, seed, depth, least) for g in groups])
    discard(rows)
    per_tree = gains.sum(axis=1, keepdims=True)
    shares = np.divide(gains, per_tree, out=np.zeros_like(gains), where=per_tree > 0).sum(axis=0)
    shares = shares / shares.sum() if shares.sum() else shares
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, shares)], "feature string, importance double")


def _grown(first: Blocks, ids: np.ndarray, classes: np.ndarray, tried: int, seed: int, depth: int | None, least: float) -> np.ndarray:
    """The decrease of the impurity by tree (numbered ``ids`` in the draws) and feature."""
    rows, trees, width, total = first, first.trees, first.width, classes.sum()
    context = first.frame.sparkSession.sparkContext
    gains = np.zeros((trees, width))
    # Numbers of the open nodes of each tree, and their rows by class.
    root = classes[None, :]
    open_ = classes.min() > 0 and total >= least
    nodes = [np.zeros(1 if open_ else 0, dtype=np.int64) for _ in range(trees)]
    counts = [root[: len(k)] for k in nodes]
    numbered = np.ones(trees, dtype=np.int64)
    level = 0
    while any(len(k) for k in nodes) and (depth is None or level < depth):
        tree_of = np.repeat(np.arange(trees), [len(k) for k in nodes])
        node_of, count_of = np.concatenate(nodes), np.concatenate(counts)
        start = np.concatenate([[0], np.cumsum([len(k) for k in nodes])])
        picked, cuts, lefts = _choose(rows, ids, tried, seed, tree_of, node_of, start, context)
        feature, gain = np.full(len(tree_of), -1), np.zeros(len(tree_of))
        cut, left = np.zeros(len(tree_of)), np.zeros((len(tree_of), 2))
        for c in range(picked.shape[1]):
            # Ties go to the feature drawn first.
            now = _decrease(count_of, lefts[:, c], total)
            better = (picked[:, c] >= 0) & (now > gain * (1 + 1e-9) + 1e-15)
            feature[better], gain[better], cut[better], left[better] = picked[better, c], now[better], cuts[better, c], lefts[better, c]
        np.add.at(gains, (tree_of[feature >= 0], feature[feature >= 0]), gain[feature >= 0])
        sides = [left, count_of - left]
        stay = [(feature >= 0) & (s.min(axis=1) > 0) & (s.sum(axis=1) >= least) for s in sides]
        slots = [np.full(len(tree_of), -1) for _ in sides]
        for t in range(trees):
            mine = slice(start[t], start[t + 1])
            split = feature[mine] >= 0
            number = numbered[t] + 2 * (np.cumsum(split) - 1)
            numbered[t] += 2 * split.sum()
            both = np.column_stack([s[mine] for s in stay]).ravel()
            slot = np.where(both, np.cumsum(both) - 1, -1).reshape(-1, 2)
            slots[0][mine], slots[1][mine] = slot[:, 0], slot[:, 1]
            nodes[t] = np.column_stack([number, number + 1]).ravel()[both]
            counts[t] = np.stack([s[mine] for s in sides], axis=1).reshape(-1, 2)[both]
        ways = np.column_stack([slots[1], slots[0]]).ravel()
        rows.pending.append(context.broadcast(Level(start, feature, cut, ways.astype(rows.kind))))  # at most trees / least_share nodes
        level += 1
        if len(rows.pending) >= CUT_LEVELS and any(len(k) for k in nodes):
            before, rows = rows, rows.written()
            if before is not first:
                discard(before.frame)
    if rows is not first:
        discard(rows.frame)
    return gains


def _decrease(counts: np.ndarray, left: np.ndarray, total: float) -> np.ndarray:
    """Weighted decrease of the Gini impurity."""
    part = lambda k: np.divide(2 * k[:, 0] * k[:, 1], k.sum(axis=1), out=np.zeros(len(k)), where=k.sum(axis=1) > 0)
    return (part(counts) - part(left) - part(counts - left)) / total


def _choose(rows: Blocks, ids, tried, seed, tree_of, node_of, start, context):
    """Per open node the drawn features (-1: constant), their thresholds and the rows by class on the left."""
    width, name = rows.width, ids[tree_of]
    k = len(tree_of)
    rank = draws(seed, name[:, None], node_of[:, None], np.arange(width)[None, :], 0)
    order = np.argsort(rank, axis=1, kind="stable")
    picked, cuts, lefts = np.full((k, tried), -1), np.zeros((k, tried)), np.zeros((k, tried, 2))
    asked = np.arange(k)
    for first in range(0, width, tried):
        columns = order[asked, first : first + tried]
        n = columns.shape[1]
        low, high = np.empty((len(asked), n)), np.empty((len(asked), n))
        for part, share in _chunks(asked, tree_of, 16 * n):
            low[share], high[share] = _spans(rows, part, columns[share], tree_of, start, context)
        u = draws(seed, name[asked][:, None], node_of[asked][:, None], columns, 1)
        cut = low + u * (high - low)
        varies = (high > low) & (cut < high)
        found = np.zeros((len(asked), n, 2))
        for part, share in _chunks(asked, tree_of, 16 * n):
            found[share] = _lefts(rows, part, columns[share], cut[share], tree_of, start, context)
        picked[asked, :n], cuts[asked, :n], lefts[asked, :n] = np.where(varies, columns, -1), cut, found
        asked = asked[~varies.any(axis=1)]
        if not len(asked):
            break
    return picked, cuts, lefts


def _chunks(asked: np.ndarray, tree_of: np.ndarray, node_bytes: int) -> Iterator[tuple[np.ndarray, slice]]:
    """Open nodes in runs whose sums fit a pass."""
    size = max(1, PASS_BYTES // node_bytes)
    for at in range(0, len(asked), size):
        yield asked[at : at + size], slice(at, min(at + size, len(asked)))


def _rows_of(slots: np.ndarray, place: np.ndarray, start: np.ndarray, trees: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per tree the rows in wanted nodes and the place of the node among those wanted."""
    for t in trees:
        rows = np.flatnonzero(slots[t] >= 0)
        at = place[start[t] + slots[t, rows]]
        inside = at >= 0
        yield (rows, at) if inside.all() else (rows[inside], at[inside])


def _wanted(part: np.ndarray, tree_of: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, list[int]]:
    place = np.full(int(start[-1]), -1)
    place[part] = np.arange(len(part))
    return place, np.unique(tree_of[part]).tolist()


def _spans(rows: Blocks, part, columns, tree_of, start, context):
    """Least and largest value of the drawn features."""
    place, used = _wanted(part, tree_of, start)
    shared = context.broadcast((place, columns))
    k, n = columns.shape

    def add(out: np.ndarray | None, x: np.ndarray, slots: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        place, columns = shared.value
        out = np.full(n * k * 2, -np.inf) if out is None else out
        flat, shift = x.ravel(), np.ascontiguousarray(columns.T) * x.shape[1]
        for mine, at in _rows_of(slots, place, start, used):
            for c in range(n):
                values = flat.take(shift[c].take(at) + mine)
                np.maximum.at(out, at + 2 * c * k, -values)
                np.maximum.at(out, at + (2 * c + 1) * k, values)
        return out

    found = rows.gathered(used, add, np.maximum).reshape(n, 2, k)
    return -found[:, 0].T, found[:, 1].T


def _lefts(rows: Blocks, part, columns, cut, tree_of, start, context):
    """Rows by class up to the thresholds."""
    place, used = _wanted(part, tree_of, start)
    shared = context.broadcast((place, columns, cut))
    k, n = columns.shape

    def add(out: np.ndarray | None, x: np.ndarray, slots: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        place, columns, cut = shared.value
        out = np.zeros((n, k * 2)) if out is None else out
        flat, shift, upto = x.ravel(), np.ascontiguousarray(columns.T) * x.shape[1], np.ascontiguousarray(cut.T)
        for mine, at in _rows_of(slots, place, start, used):
            node, count = at * 2 + y[mine], weight[mine]
            # The places of one tree's nodes lie together.
            least, most = (int(at.min()), int(at.max()) + 1) if len(at) else (0, 0)
            for c in range(n if len(at) else 0):
                goes = flat.take(shift[c].take(at) + mine) <= upto[c].take(at)
                out[c, 2 * least : 2 * most] += np.bincount(node - 2 * least, goes * count, 2 * (most - least))
        return out

    found = rows.gathered(used, add, np.add).reshape(n, k, 2)
    return found.transpose(1, 0, 2)
