"""Boosted trees over binned rows, any number of models in one pass.

Values are replaced by bins once; equal rows collapse to one with a count. Then every level of every
tree is one aggregate: each task adds up gradient sums per (model, node, feature, bin) over its rows,
and the best splits follow from the added tables. Rows are never moved. Models that differ in their
parameters or leave out another fold share the passes, so a search costs as many passes as its longest model.
Passes read blocks of rows, one array per feature; a leaf is found by one table look-up per feature.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.operators.ordering import ranked_values
from lodgeworks.session import discard, staged

MAX_BINS = 128
#: Rounds after which the scores so far are written next to the rows, so that a pass adds up few trees.
CUT_EVERY = 10
#: A task has at least so many distinct rows, as long as there are few tasks.
TASK_ROWS = 2_000
#: Distinct rows beyond which the cores have several tasks each.
MOST_ROWS = 1_000_000
#: A block has at most so many rows, and so many bytes of scores.
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 1 << 23
#: Tables of so many tasks are added up on the driver; those of more are added up by salt first.
DIRECT_TASKS = 16
#: Bytes of the sums that a task holds and hands over in one pass.
PASS_BYTES = 1 << 24
KINDS = ("second_order", "gradient", "stumps")


@dataclass(frozen=True)
class Bins:
    """Per feature the rising cuts; a value belongs to the first bin whose cut is not below it, a missing one to the last."""

    cuts: tuple[tuple[float, ...], ...]

    @property
    def size(self) -> int:
        return max(len(c) for c in self.cuts) + 2

    @property
    def missing(self) -> int:
        return self.size - 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, dtype=np.uint16)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.searchsorted(np.asarray(cuts, dtype=float), x[:, f], side="left")
        out[np.isnan(x)] = self.missing
        return out


def fit_bins(df: DataFrame, features: str = "features", max_bins: int = MAX_BINS) -> Bins:
    """Cuts half-way between neighbouring values where a feature has at most ``max_bins`` of them; else at exact quantiles.

    All rows count. The driver receives at most ``max_bins`` values per feature.
    """
    values = df.select(F.posexplode(_as_array(df, features)).alias("f", "v"))
    width = df.select(F.size(_as_array(df, features)).alias("n")).first()
    if width is None:
        raise ValueError("cannot bin an empty frame")
    ranked = ranked_values(values, ["f"], "v")
    few = ranked.groupBy("f").agg((F.count(F.lit(1)) <= max_bins).alias("few"))
    # A value that is one of few is a bin of its own; of many, the last value of each equal share of the rows.
    slot = F.when(F.col("few"), F.col("_v")).otherwise(F.floor((F.col("_n_upto") - 1) * max_bins / F.col("n")))
    edges = ranked.join(F.broadcast(few), "f").groupBy("f", "few", slot.alias("slot")).agg(F.max("_v").alias("v")).collect()
    cuts = []
    for f in range(width["n"]):
        found = sorted((r["v"], r["few"]) for r in edges if r["f"] == f)
        last = [v for v, _ in found]
        cuts.append(tuple((a + b) / 2 if few_ else a for (a, few_), b in zip(found, last[1:])))
    return Bins(tuple(cuts))


def _as_array(df: DataFrame, features: str):
    return F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(F.col(features))


def _codes(df: DataFrame, bins: Bins, features: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the bins of ``features`` as bytes."""
    rows = df.select(*keep, _as_array(df, features).alias("_x"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            codes = bins.codes(np.array(part.pop("_x").tolist(), dtype=float).reshape(len(part), len(bins.cuts)))
            yield part.assign(codes=[row.tobytes() for row in codes])

    return rows.mapInPandas(encode, f"{df.select(*keep)._jdf.schema().toDDL()}, codes binary")


def binned_rows(df: DataFrame, bins: Bins, features: str = "features", label: str = "label", fold: str | None = None,
                key: str | None = None) -> DataFrame:
    """The rows as bins: ``codes``, ``y``, ``fold`` (-1 without one), ``n`` equal rows and ``h``, a hash that sampling follows.

    Equal rows collapse to one; with ``key``, which sampling of rows needs, only those of equal keys do.
    """
    extra = [c for c in (label, fold, key) if c]
    codes = _codes(df.select(features, *extra), bins, features, extra)
    named = codes.select(
        "codes", F.col(label).cast("double").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
        F.xxhash64(key if key else "codes").alias("h"))
    rows = staged(named.groupBy("codes", "y", "fold", "h").agg(F.count(F.lit(1)).cast("double").alias("n")), "binned")
    size, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-size // TASK_ROWS), cores * -(-size // (cores * MOST_ROWS))))
    dealt = staged(rows.repartition(tasks), "binned")
    discard(rows)
    return dealt


@dataclass
class Tree:
    """Nodes by number; an inner node sends bins up to ``cut`` to ``left``, the missing bin to the side of ``low``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    low: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, cut: int, low: bool) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.low[node] = feature, cut, low
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for store, empty in ((self.feature, -1), (self.cut, 0), (self.low, True), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            store += [empty, empty]
        return self.left[node], self.right[node]

    def leaf_of(self, codes: np.ndarray, missing: int) -> np.ndarray:
        feature, cut, low = np.array(self.feature), np.array(self.cut), np.array(self.low)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(codes), dtype=np.int64)
        rows = np.arange(len(codes))
        inner = rows[feature[at] >= 0]
        while len(inner):
            node = at[inner]
            code = codes[inner, feature[node]]
            goes = np.where(code == missing, low[node], code <= cut[node])
            at[inner] = np.where(goes, left[node], right[node])
            inner = inner[feature[at[inner]] >= 0]
        return at

    def scores(self, codes: np.ndarray, missing: int) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(codes, missing)]

    def finder(self, size: int) -> Callable[[np.ndarray], np.ndarray]:
        """The leaf of every row of codes that are given by feature, for ``size`` bins.

        For each feature and bin a word tells which leaves, from left to right, can still be reached; the words of a row's
        bins have one leaf in common. A tree of more than 64 leaves is walked.
        """
        missing, inner = size - 1, [i for i, f in enumerate(self.feature) if f >= 0]
        if not inner:
            return lambda codes: np.zeros(codes.shape[1], dtype=np.int64)
        if len(inner) > 63:
            return lambda codes: self.leaf_of(codes.T, missing)
        leaves: list[int] = []
        below = [0] * len(self.feature)
        todo = [(0, False)]
        while todo:
            node, seen = todo.pop()
            if self.feature[node] < 0:
                below[node] = 1 << len(leaves)
                leaves.append(node)
            elif seen:
                below[node] = below[self.left[node]] | below[self.right[node]]
            else:
                todo += [(node, True), (self.right[node], False), (self.left[node], False)]
        words = {f: np.full(size, below[0], dtype=np.uint64) for f in sorted({self.feature[i] for i in inner})}
        for i in inner:
            word, cut = words[self.feature[i]], min(self.cut[i] + 1, missing)
            goes_left, goes_right = (np.uint64(below[0] ^ below[side]) for side in (self.right[i], self.left[i]))
            word[:cut] &= goes_left
            word[cut:missing] &= goes_right
            word[missing] &= goes_left if self.low[i] else goes_right
        node_of = np.array(leaves)

        def find(codes: np.ndarray) -> np.ndarray:
            left = None
            for f, word in words.items():
                now = word[codes[f]]
                left = now if left is None else np.bitwise_and(left, now, out=left)
            # One bit is left; its place is the exponent of the number.
            return node_of[(left.astype(np.float64).view(np.int64) >> 52) - 1023]

        return find

    def scorer(self, size: int) -> Callable[[np.ndarray], np.ndarray]:
        """The score of every row of codes that are given by feature."""
        find, value = self.finder(size), np.asarray(self.value)
        if len(self.feature) == 3:  # one split
            f, by_bin = self.feature[0], value[find({self.feature[0]: np.arange(size)})]
            return lambda codes: by_bin[codes[f]]
        return lambda codes: value[find(codes)]


@dataclass(frozen=True)
class Boost:
    """Parameters of one boosted model.

    ``second_order``: logistic loss, gain ``G^2 / (H + penalty)`` less ``least_gain`` per split, leaves ``-G / (H + penalty)``.
    ``gradient``: first-order trees on the residuals, leaves by one Newton step, from the prior log-odds.
    ``stumps``: re-weighted votes of trees of depth one (SAMME, two classes).
    """

    kind: str = "second_order"
    rounds: int = 100
    depth: int = 6
    step: float = 0.3
    penalty: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    min_leaf: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")
        if not (self.rounds >= 1 and self.depth >= 1 and self.step > 0 and 0 < self.row_share <= 1 and 0 < self.column_share <= 1):
            raise ValueError(f"unusable parameters {self}")


def _draw(seed: int, *at: int) -> np.random.Generator:
    return np.random.default_rng([seed, *at])


def _kept(hashes: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    """Which rows a round sees: a hash of row and round against the share."""
    salt = np.uint64((seed * 0x9E3779B97F4A7C15 + (round_ + 1) * 0xBF58476D1CE4E5B9) % 2**64)
    mixed = (hashes.view(np.uint64) ^ salt) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2**53 < share


def _channels(model: Boost, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a row adds to its bin: gradient and Hessian, or its weight by class."""
    if model.kind == "stumps":
        weight = np.exp(-(2 * y - 1) * raw / 2)
        return weight * y, weight * (1 - y)
    p = 1 / (1 + np.exp(-raw))
    return (p - y if model.kind == "second_order" else y - p), p * (1 - p)


class Path:
    """One model while it grows. ``left_out`` is the fold it does not see."""

    def __init__(self, model: Boost, left_out: int | None, n_features: int) -> None:
        self.model, self.left_out, self.n_features = model, left_out, n_features
        self.base = 0.0
        self.trees: list[Tree] = []
        self.gains = np.zeros(n_features)
        self.done = False
        self.start()

    def start(self) -> None:
        """A new tree with its root to be split."""
        self.tree, self.level = Tree(), 0
        self.tables: dict[int, np.ndarray] = {}
        self.asked, self.siblings = [0], {}
        n = max(1, round(self.model.column_share * self.n_features))
        self.columns = np.sort(_draw(self.model.seed, len(self.trees)).permutation(self.n_features)[:n])

    def take(self, node: int, table: np.ndarray) -> None:
        """The sums of a node; those of its sibling are what is left of the parent's."""
        self.tables[node] = table
        if node in self.siblings:
            sibling, parent = self.siblings.pop(node)
            rest = parent - table
            rest[..., 1:] = np.maximum(rest[..., 1:], 0.0)
            self.tables[sibling] = rest

    def split(self) -> None:
        """Split the nodes whose sums are known; the smaller child of each is asked for next."""
        self.asked, known = [], self.tables
        self.tables = {}
        for node, table in sorted(known.items()):
            total = table[self.columns[0]].sum(axis=0)
            best = best_split(self.model, table, self.columns) if self.level < self.model.depth else None
            if best is None:
                self.tree.value[node] = _leaf(self.model, total)
                continue
            gain, feature, cut, low, size_left, size_right = best
            self.gains[feature] += gain
            left, right = self.tree.grow(node, feature, cut, low)
            if self.level + 1 == self.model.depth:
                sums = _side(table[feature], cut, low)
                self.tree.value[left], self.tree.value[right] = _leaf(self.model, sums), _leaf(self.model, total - sums)
                continue
            small, large = (left, right) if size_left <= size_right else (right, left)
            self.asked.append(small)
            self.siblings[small] = (large, table)
        self.level += 1
        if not self.asked:
            self.finish()

    def finish(self) -> None:
        model = self.model
        if model.kind == "stumps":
            if self.vote():
                self.trees.append(self.tree)
        else:
            self.tree.value = [model.step * v for v in self.tree.value]
            self.trees.append(self.tree)
        if len(self.trees) >= model.rounds:
            self.done = True
        if not self.done:
            self.start()

    def vote(self) -> bool:
        """The stump's say: leaves hold the weights by class until here. Ends the path when a stump is perfect or no better than chance."""
        leaves = [i for i, f in enumerate(self.tree.feature) if f < 0]
        weights = {i: self.tree.value[i] for i in leaves}
        bad = sum(min(w) for w in weights.values())
        error = bad / sum(sum(w) for w in weights.values())
        if error >= 0.5:
            self.done = True
            self.tree.value = [0.0] * len(self.tree.value)
            return False
        say = 1.0 if error <= 0 else self.model.step * math.log((1 - error) / error)
        self.done = error <= 0
        self.tree.value = [0.0 if i not in weights else say if weights[i][0] > weights[i][1] else -say for i in range(len(self.tree.value))]
        return True


def _leaf(model: Boost, total: np.ndarray):
    a, b, _ = total
    if model.kind == "stumps":
        return (float(a), float(b))
    if model.kind == "second_order":
        return float(-a / (b + model.penalty))
    return float(a / b) if b > 1e-150 else 0.0


def _side(table: np.ndarray, cut: int, low: bool) -> np.ndarray:
    """Sums of the left side: bins up to the cut, and the missing bin if it goes there."""
    left = table[: cut + 1].sum(axis=0)
    return left + table[-1] if low else left


def best_split(model: Boost, table: np.ndarray, columns: np.ndarray):
    """Gain, feature, cut, side of missing values and sizes of the best split of a node, or None.

    Ties go to the first feature, the smallest cut and missing values to the left.
    """
    best = None
    for f in columns:
        present, missing, total = table[f, :-1], table[f, -1], table[f].sum(axis=0)
        upto = present.cumsum(axis=0)
        used = upto[:, 2]
        for low in (True, False) if missing[2] > 0 else (True,):
            left = upto + missing if low else upto
            right = total - left
            gain = _gain(model, left, right, total)
            # Some present value goes left; a cut behind the last one parts the missing values from the rest.
            fits = (left[:, 2] >= max(model.min_leaf, 1) - 1e-6) & (right[:, 2] >= max(model.min_leaf, 1) - 1e-6) & (used > 0)
            if model.kind == "second_order":
                fits &= (left[:, 1] >= model.least_hessian) & (right[:, 1] >= model.least_hessian)
            if not fits.any():
                continue
            gain = np.where(fits, gain, -np.inf)
            at = int(gain.argmax())
            if best is None or gain[at] > best[0] * (1 + 1e-9) + 1e-15:
                best = (float(gain[at]), int(f), at, low, float(left[at, 2]), float(right[at, 2]))
    return best if best is not None and best[0] > 1e-12 else None


def _gain(model: Boost, left: np.ndarray, right: np.ndarray, total: np.ndarray) -> np.ndarray:
    if model.kind == "second_order":
        part = lambda t: t[..., 0] ** 2 / (t[..., 1] + model.penalty)
        return (part(left) + part(right) - part(total)) / 2 - model.least_gain
    with np.errstate(divide="ignore", invalid="ignore"):
        if model.kind == "gradient":
            gain = left[:, 2] * right[:, 2] / total[2] * (left[:, 0] / left[:, 2] - right[:, 0] / right[:, 2]) ** 2
        else:
            # Decrease of the Gini impurity, weighted.
            part = lambda t: 2 * t[..., 0] * t[..., 1] / (t[..., 0] + t[..., 1])
            gain = (part(total) - np.nan_to_num(part(left)) - np.nan_to_num(part(right))) / (total[0] + total[1])
    return np.nan_to_num(gain, nan=-np.inf, posinf=-np.inf)


@dataclass
class Asked:
    """What a task needs to know of a path: its parameters, the trees since the last cut, the tree in hand and the nodes asked for."""

    path: int
    model: Boost
    left_out: int | None
    round_: int
    recent: list[Tree]
    tree: Tree
    nodes: list[int]
    kept: int | None  # the place of its scores; those of trees of depth one are looked up, not kept
    base: float


@dataclass
class Block:
    """Many rows: ``codes`` and ``raw`` by feature and by path whose scores are kept."""

    codes: np.ndarray
    y: np.ndarray
    n: np.ndarray
    fold: np.ndarray
    h: np.ndarray
    raw: np.ndarray


_BLOCK = "rows int, codes binary, y binary, n binary, fold binary, h binary, raw binary"


def _code_type(bins: Bins) -> type:
    return np.uint8 if bins.size <= 256 else np.uint16


def _blocks(rows: DataFrame, bins: Bins, start: Sequence[float] = ()) -> DataFrame:
    """``binned_rows`` by the block; the scores that are kept begin at ``start``."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, len(start)))))
    kind = _code_type(bins)

    def one(part: pd.DataFrame) -> dict:
        codes = np.frombuffer(b"".join(part["codes"]), dtype=np.uint16).reshape(len(part), len(bins.cuts))
        raw = np.repeat(np.array(start, dtype=np.float64), len(part))
        return {"rows": len(part), "codes": np.ascontiguousarray(codes.T.astype(kind)).tobytes(), "y": part["y"].to_numpy(np.float64).tobytes(),
                "n": part["n"].to_numpy(np.float64).tobytes(), "fold": part["fold"].to_numpy(np.int32).tobytes(),
                "h": part["h"].to_numpy(np.int64).tobytes(), "raw": raw.tobytes()}

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for part in batches:
            while len(part):
                held.append(part.iloc[: most - size])
                part, size = part.iloc[most - size :], size + len(held[-1])
                if size == most:
                    yield pd.DataFrame([one(pd.concat(held))])
                    held, size = [], 0
        if size:
            yield pd.DataFrame([one(pd.concat(held))])

    return rows.mapInPandas(pack, _BLOCK)


def _block(row: Any, bins: Bins) -> Block:
    cell = lambda name, kind: np.frombuffer(row[name], dtype=kind)
    return Block(cell("codes", _code_type(bins)).reshape(len(bins.cuts), row["rows"]), cell("y", np.float64), cell("n", np.float64),
                 cell("fold", np.int32), cell("h", np.int64), cell("raw", np.float64).reshape(-1, row["rows"]))


def _opened(batch: pa.RecordBatch, bins: Bins) -> Iterator[Block]:
    for at in range(batch.num_rows):
        yield _block({name: batch.column(name)[at].as_py() for name in batch.schema.names}, bins)


def _held(blocks: DataFrame, bins: Bins) -> RDD:
    """The blocks of all tasks, kept for many passes. A pass over an RDD needs no plan, which costs more than the sums of few rows."""
    return blocks.rdd.map(lambda row: _block(row, bins)).persist(StorageLevel.MEMORY_AND_DISK)


class _Seen:
    """The rows of a block that a path sees; those of equal folds are cut out once."""

    def __init__(self, block: Block, size: int) -> None:
        self.block, self.size, self.known, self.classes = block, size, {}, {}

    def of(self, a: Asked) -> tuple:
        """Places (None: all), codes, labels and counts of the rows."""
        sampled = a.model.row_share < 1
        at = (a.left_out, a.path if sampled else None)
        if at not in self.known:
            b = self.block
            use = np.ones(len(b.y), dtype=bool) if a.left_out is None else b.fold != a.left_out
            if sampled:
                use &= _kept(b.h, a.model.seed, a.round_, a.model.row_share)
            if use.all():
                found = None, b.codes, b.y, b.n
            else:
                use = np.flatnonzero(use)
                found = use, b.codes[:, use], b.y[use], b.n[use]
            if sampled:
                return found
            self.known[at] = found
        return self.known[at]

    def by_class(self, a: Asked) -> tuple | None:
        """The place of every row among (class, bin) by feature, minus half its sign, and the counts by feature and bin; None for other labels."""
        if a.model.row_share < 1:
            return None
        if a.left_out not in self.classes:
            _, codes, label, count = self.of(a)
            found = None
            if np.isin(label, (0.0, 1.0)).all():
                first = (label * self.size).astype(np.int64)
                counts = np.stack([np.bincount(c, count, self.size) for c in codes])
                found = [first + c for c in codes], (1 - 2 * label) / 2, counts
            self.classes[a.left_out] = found
        return self.classes[a.left_out]


def _stump_tables(trees: Sequence[Tree], n_features: int, size: int) -> dict[int, np.ndarray]:
    """The sum of trees of depth one as a number per feature and bin."""
    tables: dict[int, np.ndarray] = {}
    for tree in trees:
        f = tree.feature[0]
        if f < 0:  # a tree of one leaf
            tables[0] = tables.get(0, np.zeros(size)) + tree.value[0]
        else:
            tables[f] = tables.get(f, np.zeros(size)) + np.asarray(tree.value)[tree.finder(size)({f: np.arange(size)})]
    return tables


def _sums(rows: RDD, tasks: int, asked: list[Asked], bins: Bins) -> dict[int, np.ndarray]:
    """Per path the sums (node, feature, bin, channel) over all rows of the blocks."""
    n_features, size = len(bins.cuts), bins.size

    def added(a: Asked, block: Block, seen: _Seen, scorers: list, tables: dict, find: Callable, out: np.ndarray) -> None:
        use, codes, label, count = seen.of(a)
        if a.model.kind == "stumps" and a.kept is None and len(a.tree.feature) == 1 and (by_class := seen.by_class(a)) is not None:
            # A row adds its weight to its class only, and the counts are those of all paths that see the same rows.
            places, sign, counts = by_class
            raw = np.full(len(label), a.base)
            for f, table in tables.items():
                raw += table[codes[f]]
            raw *= sign
            weight = np.exp(raw, out=raw)
            weight *= count
            for f in range(n_features):
                by_bin = np.bincount(places[f], weight, 2 * size)
                out[0, f, :, 0] += by_bin[size:]
                out[0, f, :, 1] += by_bin[:size]
            out[0, :, :, 2] += counts
            return
        if a.kept is None:
            raw = np.full(len(label), a.base)
            for f, table in tables.items():
                raw += table[codes[f]]
        else:
            raw = block.raw[a.kept] if use is None else block.raw[a.kept][use]
            for score in scorers:
                raw = raw + score(codes)
        first, second = _channels(a.model, raw, label)
        slots = np.full(len(a.tree.feature), -1)
        slots[a.nodes] = np.arange(len(a.nodes))
        if len(a.tree.feature) == 1:  # all rows are in the root
            slot = np.zeros(len(label), dtype=np.int64)
        else:
            slot = slots[find(codes)]
            inside = np.flatnonzero(slot >= 0)
            if len(inside) < len(slot):
                slot, codes, first, second, count = slot[inside], codes[:, inside], first[inside], second[inside], count[inside]
        weights = first * count, second * count, count
        slot *= size
        for f in range(n_features):
            at = slot + codes[f]
            for c, weight in enumerate(weights):
                out[:, f, :, c] += np.bincount(at, weight, len(a.nodes) * size).reshape(len(a.nodes), size)

    def add(task: int, blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        ready = []
        for a in asked:
            shallow = a.kept is None
            ready.append((a, [] if shallow else [t.scorer(size) for t in a.recent],
                          _stump_tables(a.recent, n_features, size) if shallow else {}, a.tree.finder(size),
                          np.zeros((len(a.nodes), n_features, size, 3))))
        any_ = False
        for block in blocks:
            seen, any_ = _Seen(block, size), True
            for a, scorers, tables, find, out in ready:
                added(a, block, seen, scorers, tables, find, out)
        if any_:
            for a, *_, out in ready:
                yield (task % DIRECT_TASKS, a.path), out

    parts = rows.mapPartitionsWithIndex(add)
    if tasks > DIRECT_TASKS:
        # Tables of one path added up, by salt.
        parts = parts.reduceByKey(np.add, DIRECT_TASKS)
    total: dict[int, np.ndarray] = {}
    for (_, path), table in parts.collect():  # at most DIRECT_TASKS times PASS_BYTES
        total[path] = total[path] + table if path in total else table
    return total


def _scored(rows: DataFrame, recent: dict[int, list[Tree]], bins: Bins) -> DataFrame:
    """The blocks with the trees since the last cut added to ``raw``, by place among the scores that are kept."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {p: [t.scorer(bins.size) for t in trees] for p, trees in recent.items()}
        for batch in batches:
            raws = []
            for block in _opened(batch, bins):
                raw = block.raw.copy()
                for p, scorers in ready.items():
                    for s in scorers:
                        raw[p] += s(block.codes)
                raws.append(raw.tobytes())
            yield batch.set_column(batch.schema.get_field_index("raw"), "raw", pa.array(raws, pa.binary()))

    return rows.mapInArrow(score, _BLOCK)


def _prior(rows: DataFrame, paths: list[Path]) -> None:
    """``gradient`` starts from the log-odds of the rows it sees."""
    if not any(p.model.kind == "gradient" for p in paths):
        return
    sums = {r["fold"]: (r["ones"], r["n"]) for r in rows.groupBy("fold").agg(F.sum(F.col("y") * F.col("n")).alias("ones"), F.sum("n").alias("n")).collect()}
    for path in paths:
        if path.model.kind == "gradient":
            ones, n = (sum(v[i] for f, v in sums.items() if f != path.left_out) for i in (0, 1))
            if not 0 < ones < n:
                raise ValueError("both labels are needed")
            path.base = math.log(ones / (n - ones))


def grow(rows: DataFrame, bins: Bins, models: Sequence[tuple[Boost, int | None]]) -> list[Path]:
    """Grow all models (each with the fold it leaves out, or None) over ``binned_rows``, a level of all trees in hand per pass.

    The driver holds the trees and the sums of the nodes in hand: (node, feature, bin), whatever the rows.
    """
    paths = [Path(m, left_out, len(bins.cuts)) for m, left_out in models]
    if rows.isEmpty():
        raise ValueError("no training rows")
    _prior(rows, paths)
    # Trees of depth one add up to a number per feature and bin; the scores of deeper ones are kept with the rows.
    kept = {i: at for at, i in enumerate(i for i, p in enumerate(paths) if p.model.depth > 1)}
    blocks = _blocks(rows, bins, [paths[i].base for i in kept])
    now = _held(blocks, bins)
    scored = None
    written = [0] * len(paths)
    tasks = rows.rdd.getNumPartitions()
    most = max(1, PASS_BYTES // (len(bins.cuts) * bins.size * 3 * 8))
    while open_ := [i for i, p in enumerate(paths) if not p.done]:
        asked, nodes = [], 0
        for i in open_:
            p = paths[i]
            take = p.asked[: most - nodes]
            if not take:
                break  # the other paths keep their nodes for a later pass
            nodes += len(take)
            asked.append(Asked(i, p.model, p.left_out, len(p.trees), p.trees[written[i]:], p.tree, take, kept.get(i), p.base))
        sums = _sums(now, tasks, asked, bins)
        for a in asked:
            p = paths[a.path]
            table = sums.get(a.path)
            if table is None:
                raise ValueError("a model sees no rows")
            for node, t in zip(a.nodes, table):
                p.take(node, t)
            p.asked = p.asked[len(a.nodes):]
            if not p.asked:
                p.split()
        open_ = [i for i in kept if not paths[i].done]
        if any(len(paths[i].trees) - written[i] >= CUT_EVERY for i in open_):
            recent = {i: paths[i].trees[written[i]:] for i in open_ if len(paths[i].trees) > written[i]}
            before, blocks = scored, staged(_scored(blocks, {kept[i]: t for i, t in recent.items()}, bins), "scores")
            scored = blocks
            now.unpersist()
            now = _held(blocks, bins)
            if before is not None:
                discard(before)
            for i in recent:
                written[i] = len(paths[i].trees)
    now.unpersist()
    if scored is not None:
        discard(scored)
    return paths


def held_out_accuracy(rows: DataFrame, bins: Bins, paths: Sequence[Path], wanted: Sequence[tuple[int, int]]) -> list[float]:
    """For each of ``wanted`` (a path, a number of its first trees) the share of right answers on the fold that it left out, in one pass."""
    grown = [(p.base, p.trees, p.left_out) for p in paths]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(len(wanted)), np.zeros(len(wanted))
        scorers = [[t.scorer(bins.size) for t in trees] for _, trees, _ in grown]
        for block in (b for batch in batches for b in _opened(batch, bins)):
            for p, (base, trees, left_out) in enumerate(grown):
                # Shorter paths are read off on the way along the longest one.
                asked = sorted((rounds, w) for w, (path, rounds) in enumerate(wanted) if path == p)
                use = np.flatnonzero(block.fold == left_out)
                codes, y, n = block.codes[:, use], block.y[use], block.n[use]
                raw, done = np.full(len(use), base), 0
                for rounds, w in asked:
                    for score in scorers[p][done:rounds]:
                        raw += score(codes)
                    done = max(done, rounds)
                    right[w] += (n * ((raw > 0) == (y > 0))).sum()
                    seen[w] += n.sum()
        yield pa.RecordBatch.from_pydict({"w": pa.array(range(len(wanted)), pa.int32()), "right": right, "seen": seen})

    sums = _blocks(rows, bins).mapInArrow(judge, "w int, right double, seen double").groupBy("w").agg(F.sum("right"), F.sum("seen")).collect()
    found = {w: a / b if b else float("nan") for w, a, b in sums}
    return [found[w] for w in range(len(wanted))]


class BoostedModel:
    """The trees of a path; ``transform`` adds ``probability_one`` and ``prediction``.

    ``rounds`` uses only the first trees: a path of many rounds holds every shorter one.
    """

    def __init__(self, bins: Bins, base: float, trees: list[Tree], kind: str, gains: Sequence[float] = ()) -> None:
        self.bins, self.base, self.trees, self.kind, self.gains = bins, base, trees, kind, tuple(float(g) for g in gains)
        if not trees:
            raise ValueError("no stump is better than chance")

    @classmethod
    def of(cls, path: Path, bins: Bins, rounds: int | None = None) -> BoostedModel:
        return cls(bins, path.base, path.trees[:rounds], path.model.kind, path.gains)

    def importance(self) -> list[float]:
        """The share of each feature in the gain of all splits."""
        total = sum(self.gains)
        return [g / total if total else 0.0 for g in self.gains]

    def scorers(self) -> list[Callable[[np.ndarray], np.ndarray]]:
        return [t.scorer(self.bins.size) for t in self.trees]

    def raw(self, x: np.ndarray, scorers: Sequence[Callable[[np.ndarray], np.ndarray]] | None = None) -> np.ndarray:
        codes = np.ascontiguousarray(self.bins.codes(x).T)
        return self.base + sum((s(codes) for s in scorers or self.scorers()), np.zeros(len(x)))

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows score on their own; the trees travel with the function."""
        model = self

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorers = model.scorers()
            for features in parts:
                yield pd.Series(model.raw(np.array(features.tolist(), dtype=float).reshape(len(features), len(model.bins.cuts)), scorers))

        scored = df.withColumn("_raw", score(_as_array(df, "features")))
        return scored.withColumns({"probability_one": 1 / (1 + F.exp(-F.col("_raw"))), "prediction": (F.col("_raw") > 0).cast("double")}).drop("_raw")

    def rows(self) -> list[tuple]:
        return [(i, j, t.feature[j], t.cut[j], t.low[j], t.left[j], t.right[j], t.value[j]) for i, t in enumerate(self.trees) for j in range(len(t.feature))]

    def save(self, spark: SparkSession, path: str) -> dict:
        """A table of nodes below ``path``; the rest as plain values."""
        spark.createDataFrame(self.rows(), "tree int, node int, feature int, cut int, low boolean, left int, right int, value double") \
            .write.mode("overwrite").parquet(f"{path}/nodes")
        return {"base": self.base, "kind_of": self.kind, "gains": list(self.gains), "cuts": json.dumps(self.bins.cuts)}

    @classmethod
    def load(cls, spark: SparkSession, path: str, meta: dict) -> BoostedModel:
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            t = trees.setdefault(r["tree"], Tree([], [], [], [], [], []))
            for name in ("feature", "cut", "low", "left", "right", "value"):
                getattr(t, name).append(r[name])
        bins = Bins(tuple(tuple(c) for c in json.loads(meta["cuts"])))
        return cls(bins, meta["base"], [trees[i] for i in sorted(trees)], meta["kind_of"], meta["gains"])


class BoostedTrees:
    """A classifier of one ``Boost``; ``key`` names the column that sampling of rows follows."""

    def __init__(self, model: Boost, key: str | None = None, max_bins: int = MAX_BINS) -> None:
        self.model, self.key, self.max_bins = model, key, max_bins

    def fit(self, df: DataFrame) -> BoostedModel:
        return fit_together([(self, None)], df)[0]


def fit_together(wanted: Sequence[tuple[BoostedTrees, int | None]], df: DataFrame, fold: str | None = None) -> list[BoostedModel | Exception]:
    """All models of ``wanted`` (each with the fold it leaves out) grown in the same passes; a model that cannot be is its error.

    They share the bins of all rows.
    """
    bins = fit_bins(df, max_bins=max(c.max_bins for c, _ in wanted))
    sampled = next((c.key for c, _ in wanted if c.model.row_share < 1), None)
    paths = grow(binned_rows(df, bins, fold=fold, key=sampled), bins, [(c.model, left_out) for c, left_out in wanted])
    found: list[BoostedModel | Exception] = []
    for path in paths:
        try:
            found.append(BoostedModel.of(path, bins))
        except ValueError as error:
            if len(wanted) == 1:
                raise
            found.append(error)
    return found
