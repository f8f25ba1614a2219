"""A random forest over binned rows, all trees of a level in one pass.

Values are replaced by bins once, whose cuts are picked from many exact quantiles: half of them where the class changes most, half at
equal shares of the rows, so that few bins still part the classes. Rows of equal bins and label collapse to one cell with a count, and a tree sees a cell as often
as a Poisson draw with that count as its mean says: the sum of one draw per row. So a pass reads cells, whose number the bins
bound, however many rows there are. Cells stay where they are and carry their open node in every tree that has drawn them; cells in
leaves drop out. The sums per (node, drawn feature, bin, class) meet by runs of nodes, and only the chosen splits reach the driver.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.operators.boosting import Bins, _as_array, _codes, fit_bins
from lodgeworks.operators.extratrees import draws
from lodgeworks.session import staged

#: Bins of a feature, and the finer ones whose cuts they are picked from.
MAX_BINS, FINE_BINS = 32, 1024
#: Pairs of a cell and a tree in a block, and blocks of a task beyond which the cores have several tasks each.
BLOCK_PAIRS, TASK_BLOCKS = 1 << 20, 16
#: Bytes of the sums of a run of nodes, and of all that a task adds up in whole tables; beyond, it sorts what it has seen.
RUN_BYTES, TABLE_BYTES = 1 << 22, 1 << 25
#: Sums that a task sorts at once.
SORTED = 1 << 22
#: Levels after which the cells are kept with their nodes.
CUT_LEVELS = 4
#: Cells of a grid that is scored once for all; a model of more scores rows on their own.
GRID_CELLS = 1 << 23


@dataclass(frozen=True)
class Forest:
    """``trees`` of ``depth`` levels; a split leaves ``min_leaf`` drawn rows on either side and draws the square root of the features."""

    trees: int = 100
    depth: int = 15
    seed: int = 42
    min_leaf: int = 1
    impurity: str = "gini"

    def __post_init__(self) -> None:
        if not (self.trees >= 1 and self.depth >= 0 and self.min_leaf >= 1 and self.impurity in ("gini", "entropy")):
            raise ValueError(f"unusable parameters {self}")


@dataclass
class Level:
    """The chosen splits of a level: per open node the feature (-1: a leaf), the last bin on the left, the children's places (-1: leaves)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray


@dataclass
class Block:
    """Cells, ``codes`` by feature; ``pairs`` are the cell, the open node and the drawn weight, or None before any level."""

    number: int
    codes: np.ndarray
    y: np.ndarray
    n: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def drawn(self, settings: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each tree sees each cell; a draw depends on the seed and the block alone."""
        rng = np.random.default_rng([settings.seed, self.number])
        weight = rng.poisson(self.n, (settings.trees, len(self.n)))
        tree, cell = np.nonzero(weight)
        return cell.astype(np.int32), tree.astype(np.int32), weight[tree, cell].astype(np.float64)

    def after(self, settings: Forest, levels: Sequence[Level]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell, node, weight = self.pairs or self.drawn(settings)
        flat, cells = self.codes.ravel(), len(self.n)
        for level in levels:
            feature = level.feature[node]
            inner = np.flatnonzero(feature >= 0)
            cell, node, weight = cell[inner], node[inner], weight[inner]
            goes = flat.take(feature[inner].astype(np.int64) * cells + cell) <= level.cut[node]
            node = np.where(goes, level.left[node], level.right[node])
            open_ = np.flatnonzero(node >= 0)
            cell, node, weight = cell[open_], node[open_], weight[open_]
        return cell, node, weight


def impurity_of(counts: np.ndarray, kind: str) -> np.ndarray:
    """Impurity of (..., class) counts times their sum; 0 without rows."""
    n = counts.sum(axis=-1)
    if kind == "gini":
        return np.divide(2 * counts[..., 0] * counts[..., 1], n, out=np.zeros(n.shape), where=n > 0)
    share = np.divide(counts, n[..., None], out=np.zeros(counts.shape), where=n[..., None] > 0)
    return -(counts * np.log2(share, out=np.zeros(counts.shape), where=share > 0)).sum(axis=-1)


def best_splits(table: np.ndarray, columns: np.ndarray, settings: Forest) -> tuple[np.ndarray, ...]:
    """Of (node, drawn feature, bin, class) sums the feature (-1: none), the cut and the classes on the left and in all.

    Ties go to the feature drawn first and to the smallest cut.
    """
    k, m, size, _ = table.shape
    total = table[:, 0].sum(axis=1)
    left = table.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    gain = impurity_of(total, settings.impurity)[:, None, None] - impurity_of(left, settings.impurity) - impurity_of(right, settings.impurity)
    fits = (left.sum(axis=3) >= settings.min_leaf) & (right.sum(axis=3) >= settings.min_leaf)
    gain = np.where(fits, gain, -np.inf).reshape(k, -1)
    least = 1e-12 * total.sum(axis=1)
    at, node = (gain >= gain.max(axis=1, keepdims=True) - least[:, None]).argmax(axis=1), np.arange(k)
    drawn, cut = np.divmod(at, size - 1)
    found = gain[node, at] > least
    return np.where(found, columns[node, drawn], -1), cut, left[node, drawn, cut], total


def picked_cuts(counts: np.ndarray, most: int) -> list[int]:
    """Places of at most ``most`` cuts between fine bins, of whose (bin, class) counts half follow the class, the rest equal shares.

    The first half splits the feature alone, the largest decrease of the Gini impurity first.
    """
    if len(counts) - 1 <= most:
        return list(range(len(counts) - 1))
    upto = np.vstack([np.zeros((1, 2)), counts.cumsum(axis=0)])

    def best(a: int, b: int) -> list[tuple[float, int, int, int]]:
        """The split of the fine bins from ``a`` to ``b``, if any."""
        left = upto[a + 1 : b] - upto[a]
        if not len(left):
            return []
        total = upto[b] - upto[a]
        gain = impurity_of(total, "gini") - impurity_of(left, "gini") - impurity_of(total - left, "gini")
        at = int(gain.argmax())
        return [(-float(gain[at]), a + 1 + at, a, b)] if gain[at] > 1e-12 * total.sum() else []

    open_, cuts = best(0, len(counts)), set()
    while open_ and len(cuts) < most // 2:
        _, at, a, b = heapq.heappop(open_)
        cuts.add(at)
        for segment in (best(a, at), best(at, b)):
            for one in segment:
                heapq.heappush(open_, one)
    shares, n = upto.sum(axis=1), most - len(cuts) + 1
    cuts.update(np.clip(np.searchsorted(shares, shares[-1] * np.arange(1, n) / n), 1, len(counts) - 1).tolist())
    return [at - 1 for at in sorted(cuts)]


def class_bins(df: DataFrame, features: str, label: str, most: int) -> Bins:
    """At most ``most`` bins per feature, picked from finer ones by the classes of all rows."""
    fine = fit_bins(df, features, max(FINE_BINS, most))
    width, size = len(fine.cuts), fine.size
    first = 2 * size * np.arange(width)[None, :]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(width * size * 2, dtype=np.int64)
        for part in batches:
            if not part["y"].isin((0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            codes = np.frombuffer(b"".join(part["codes"]), dtype=np.uint16).reshape(len(part), width).astype(np.int64)
            held += np.bincount((first + 2 * codes + part["y"].to_numpy(np.int64)[:, None]).ravel(), minlength=len(held))
        at = np.flatnonzero(held)
        yield pd.DataFrame({"at": at, "n": held[at]})

    coded = _codes(df, fine, features, [label]).select("codes", F.col(label).cast("double").alias("y"))
    counts = np.zeros(width * size * 2)
    for r in coded.mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # bins and classes
        counts[r["at"]] = r["n"]
    counts = counts.reshape(width, size, 2)
    return Bins(tuple(tuple(c[i] for i in picked_cuts(counts[f, : len(c) + 1], most - 1)) for f, c in enumerate(fine.cuts)))


def _sparse(keys: np.ndarray, sums: np.ndarray, run: int) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Sums by rising key, cut into runs of so many keys."""
    first, last = (int(keys[0]) // run, int(keys[-1]) // run) if len(keys) else (0, -1)
    bounds = np.searchsorted(keys, np.arange(first, last + 2) * run)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if b > a:
            yield first + i, ((keys[a:b] - (first + i) * run).astype(np.int32), sums[a:b])


def _chosen(rows: RDD, tasks: int, settings: Forest, pending: list, columns: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """``best_splits`` of all open nodes."""
    shared = rows.context.broadcast(columns)
    k, m = columns.shape
    per_node = m * size * 2
    nodes = max(1, RUN_BYTES // (8 * per_node))
    runs = -(-k // nodes)
    whole = 8 * k * per_node <= TABLE_BYTES

    def add(blocks: Iterator[Block]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        columns, levels = shared.value, [p.value for p in pending]
        held = np.zeros(k * per_node) if whole else None
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
            keys, weights = (np.concatenate(x) for x in zip(*kept))
            kept.clear()
            order = np.argsort(keys)
            keys, weights = keys[order], weights[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            yield from _sparse(keys[first], np.add.reduceat(weights, first), nodes * per_node)

        for block in blocks:
            cell, node, weight = block.after(settings, levels)
            flat, cells = block.codes.ravel(), len(block.n)
            low = block.y[cell].astype(np.int64) + node.astype(np.int64) * per_node
            for c in range(m if len(cell) else 0):
                code = flat.take(columns[node, c].astype(np.int64) * cells + cell)
                keys = low + 2 * (c * size + code.astype(np.int64))
                if whole:
                    # A block's nodes need not reach the last one.
                    sums = np.bincount(keys, weight)
                    held[: len(sums)] += sums
                else:
                    kept.append((keys, weight))
            if sum(len(x) for x, _ in kept) >= SORTED:
                yield from flush()
        if whole:
            keys = np.flatnonzero(held)
            yield from _sparse(keys, held[keys], nodes * per_node)
        elif kept:
            yield from flush()

    def choose(parts: Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple]:
        tables: dict[int, np.ndarray] = {}
        for run, (keys, sums) in parts:
            if run not in tables:
                tables[run] = np.zeros(min(nodes, k - run * nodes) * per_node)
            tables[run][keys] += sums  # keys of one part differ
        for run, table in tables.items():
            mine = shared.value[run * nodes : (run + 1) * nodes]
            yield run, best_splits(table.reshape(len(mine), m, size, 2), mine, settings)

    met = rows.mapPartitions(add).partitionBy(min(runs, max(tasks, runs // 8)), int)
    out = np.full(k, -1), np.zeros(k, dtype=np.int64), np.zeros((k, 2)), np.zeros((k, 2))
    for run, found in met.mapPartitions(choose).collect():  # the splits of the open nodes
        for whole_, part in zip(out, found):
            whole_[run * nodes : run * nodes + len(part)] = part
    return out


def _blocks(df: DataFrame, bins: Bins, settings: Forest, features: str, label: str) -> tuple[RDD, int]:
    """The cells dealt by a hash of their bins to blocks, and the number of tasks."""
    coded = _codes(df, bins, features, [label]).select("codes", F.col(label).cast("double").alias("y"))
    cells = staged(coded.groupBy("codes", "y").agg(F.count(F.lit(1)).alias("n")), "cells")
    blocks = -(-cells.count() // max(1, BLOCK_PAIRS // settings.trees))
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(blocks, cores * -(-blocks // (cores * TASK_BLOCKS))))
    width, kind = len(bins.cuts), np.uint8 if bins.size <= 256 else np.uint16

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # at most about TASK_BLOCKS blocks
        for number, some in pd.concat(parts).groupby("number") if parts else ():
            some = some.sort_values(["codes", "y"])
            codes = np.frombuffer(b"".join(some["codes"]), dtype=np.uint16).reshape(len(some), width)
            yield pd.DataFrame({"number": [number], "codes": [np.ascontiguousarray(codes.T.astype(kind)).tobytes()],
                                "y": [some["y"].to_numpy(np.uint8).tobytes()], "n": [some["n"].to_numpy(np.int64).tobytes()]})

    def opened(row) -> tuple[int, Block]:
        n = np.frombuffer(row["n"], dtype=np.int64)
        return row["number"], Block(row["number"], np.frombuffer(row["codes"], dtype=kind).reshape(width, len(n)), np.frombuffer(row["y"], dtype=np.uint8), n)

    dealt = cells.withColumn("number", F.pmod(F.xxhash64("codes"), F.lit(blocks)).cast("int")).repartition(tasks, "number")
    packed = dealt.mapInPandas(pack, "number int, codes binary, y binary, n binary").rdd.map(opened)
    return packed.partitionBy(tasks, int).values().persist(StorageLevel.MEMORY_AND_DISK), tasks


class RandomForest:
    """A classifier of one ``Forest`` for labels 0 / 1."""

    def __init__(self, settings: Forest, max_bins: int = MAX_BINS) -> None:
        self.settings, self.max_bins = settings, max_bins

    def fit(self, df: DataFrame, features: str = "features", label: str = "label") -> ForestModel:
        """A level of all trees per pass; the driver holds the nodes."""
        settings = self.settings
        bins = class_bins(df, features, label, self.max_bins)
        rows, tasks = _blocks(df, bins, settings, features, label)
        held, context = [rows], df.sparkSession.sparkContext
        width, trees = len(bins.cuts), settings.trees
        tried = math.ceil(math.sqrt(width))
        # Per level the features, cuts, children and classes of its nodes; the roots come first.
        levels: list[list[np.ndarray]] = []
        count = np.zeros((trees, 2))
        number, open_ = np.arange(trees), np.arange(trees)
        pending: list = []
        for depth in range(settings.depth + 1):
            k = len(number)
            feature, cut, left = np.full(k, -1), np.zeros(k, dtype=np.int64), np.full(k, -1)
            levels.append([feature, cut, left, count])
            last = depth == settings.depth
            if not len(open_) or (last and depth):
                break
            rank = draws(settings.seed, np.array(0), number[open_][:, None], np.arange(width)[None, :], 0)
            columns = np.argsort(rank, axis=1, kind="stable")[:, :tried].astype(np.int16)
            found, at, lefts, total = _chosen(rows, tasks, settings, pending, columns, bins.size)
            for old in held[:-1]:
                old.unpersist()
            held = held[-1:]
            if not depth:
                count[:] = total
            if last:
                break
            feature[open_], cut[open_] = found, at
            split = np.flatnonzero(found >= 0)
            base = number[-1] + 1
            left[open_[split]] = base + 2 * np.arange(len(split))
            count = np.stack([lefts[split], total[split] - lefts[split]], axis=1).reshape(-1, 2)
            number = base + np.arange(len(count))
            more = (count.min(axis=1) > 0) & (depth + 1 < settings.depth)
            open_ = np.flatnonzero(more)
            place = np.where(more, np.cumsum(more) - 1, -1).reshape(-1, 2)
            sides = np.full((2, len(found)), -1, dtype=np.int32)
            sides[:, split] = place.T
            pending.append(context.broadcast(Level(found.astype(np.int16), at.astype(np.int32), *sides)))
            if len(pending) >= CUT_LEVELS and len(open_):
                rows, pending = _kept(rows, settings, pending), []
                held.append(rows)
        for old in held:
            old.unpersist()
        return ForestModel(bins, trees, *pruned(levels))


def _kept(rows: RDD, settings: Forest, pending: list) -> RDD:
    def move(block: Block) -> Block:
        return Block(block.number, block.codes, block.y, block.n, block.after(settings, [p.value for p in pending]))

    return rows.map(move).persist(StorageLevel.MEMORY_AND_DISK)


def pruned(levels: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Features, cuts, left children and shares of label 1 of all nodes. Two leaves that vote for the same class become one; a right child follows the left one."""
    starts = np.cumsum([0, *[len(x[0]) for x in levels]])
    feature, cut, left, count = (np.concatenate(x) for x in zip(*levels))
    one = count[:, 1] > count[:, 0]
    for a, b in reversed(list(zip(starts, starts[1:]))):
        inner = a + np.flatnonzero(feature[a:b] >= 0)
        child = left[inner]
        same = (feature[child] < 0) & (feature[child + 1] < 0) & (one[child] == one[child + 1])
        feature[inner[same]] = -1
    reached = np.zeros(len(feature), dtype=bool)
    reached[: len(levels[0][0])] = True
    for a, b in zip(starts, starts[1:]):
        inner = a + np.flatnonzero(reached[a:b] & (feature[a:b] >= 0))
        reached[left[inner]] = reached[left[inner] + 1] = True
    place = np.cumsum(reached) - 1
    n = count.sum(axis=1)
    value = np.divide(count[:, 1], n, out=np.zeros(len(n)), where=n > 0)
    left = np.where(feature >= 0, place[left], -1)
    return feature[reached], cut[reached], left[reached], value[reached]


class ForestModel:
    """Trees vote with the share of label 1 in their leaf; ``transform`` adds ``probability_one`` and ``prediction``.

    Equal bins have equal scores. Where the bins make few cells, all of them are scored once and rows look theirs up.
    """

    def __init__(self, bins: Bins, trees: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, value: np.ndarray, uid: str | None = None) -> None:
        self.bins, self.trees, self.feature, self.cut, self.left, self.value = bins, trees, feature, cut, left, value
        self.uid = uid or f"Forest_{uuid.uuid4().hex[:12]}"
        # A bin per cut, one behind the last cut and one for missing values, which lies on the right of every cut.
        self.shape = tuple(len(c) + 2 for c in bins.cuts)
        self._shared = None

    @property
    def total_nodes(self) -> int:
        return len(self.feature)

    def walked(self, codes: np.ndarray) -> np.ndarray:
        """The mean vote of rows of codes that are given by feature."""
        flat, n = codes.ravel(), codes.shape[1]
        total = np.zeros(n)
        for t in range(self.trees):
            at = np.full(n, t)
            inner = np.arange(n) if self.feature[t] >= 0 else np.arange(0)
            while len(inner):
                node = at[inner]
                goes = flat.take(self.feature[node] * n + inner) <= self.cut[node]
                at[inner] = self.left[node] + ~goes
                inner = inner[self.feature[at[inner]] >= 0]
            total += self.value[at]
        return total / self.trees

    def grid(self) -> np.ndarray:
        """The mean vote of every cell: a leaf is added to the box of cells that reach it."""
        out = np.zeros(self.shape)
        feature, cut, left, value = (x.tolist() for x in (self.feature, self.cut, self.left, self.value))
        for t in range(self.trees):
            todo = [(t, out, (0,) * len(self.shape))]
            while todo:
                node, box, low = todo.pop()
                f = feature[node]
                if f < 0:
                    box += value[node]
                    continue
                before, at = (slice(None),) * f, cut[node] + 1
                todo += [(left[node], box[*before, : at - low[f]], low), (left[node] + 1, box[*before, at - low[f] :], (*low[:f], at, *low[f + 1 :]))]
        return out.ravel() / self.trees

    def scores(self, x: np.ndarray, grid: np.ndarray | None = None) -> np.ndarray:
        codes = np.minimum(self.bins.codes(x), np.array(self.shape, dtype=np.uint16) - 1)
        return self.walked(np.ascontiguousarray(codes.T)) if grid is None else grid[np.ravel_multi_index(tuple(codes.T), self.shape)]

    def transform(self, df: DataFrame) -> DataFrame:
        context = df.sparkSession.sparkContext
        if self._shared is None or self._shared[0] != context.applicationId:
            # A few bytes per cell or node; a task reads them once.
            grid = self.grid() if math.prod(self.shape) <= GRID_CELLS else None
            tree = (self.bins, self.trees, *([None] * 4 if grid is not None else [self.feature, self.cut, self.left, self.value]))
            self._shared = context.applicationId, context.broadcast((tree, grid))
        shared, width = self._shared[1], len(self.bins.cuts)

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tree, grid = shared.value
            model = ForestModel(*tree)
            for features in parts:
                yield pd.Series(model.scores(np.array(features.tolist(), dtype=float).reshape(len(features), width), grid))

        scored = df.withColumn("probability_one", score(_as_array(df, "features")))
        return scored.withColumn("prediction", (F.col("probability_one") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> dict:
        """A table of nodes below ``path``; the rest as plain values."""
        nodes = pa.table({"node": np.arange(len(self.feature)), "feature": self.feature.astype(np.int32), "cut": self.cut.astype(np.int32),
                          "left": self.left.astype(np.int64), "value": self.value})
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        return {"trees": self.trees, "uid": self.uid, "cuts": json.dumps(self.bins.cuts)}

    @classmethod
    def load(cls, spark: SparkSession, path: str, meta: dict) -> ForestModel:
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("node").toArrow()
        return cls(Bins(tuple(tuple(c) for c in json.loads(meta["cuts"]))), meta["trees"],
                   *[nodes[name].to_numpy() for name in ("feature", "cut", "left", "value")], meta["uid"])
