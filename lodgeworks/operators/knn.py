"""Exact k-nearest-neighbour classification (two classes) without comparing all pairs.

Training rows collapse to distinct (point, label) rows with a count. A k-d partition, cut from a
fixed-size sample, assigns every point to a leaf. A query first meets its home leaf, which bounds
the distance of its k-th neighbour; then it visits exactly those other leaves whose cell reaches
into that radius. Queries collapse to distinct points too; those of a busy leaf are cut into chunks
and the points of a large leaf into parts, so no task grows with a popular region, a repeated row or
the size of the table. Within a task the points of a part stand in small cells, and a query meets only
those that come within its radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeworks.session import staged

LEAF_ROWS = 20_000
CHUNK_ROWS = 20_000
PART_ROWS = 200_000  # a leaf with more points is met in parts
MAX_LEAVES = 4_096
SAMPLES_PER_LEAF = 20
BLOCK_CELLS = 4_000_000
CELL_ROWS = 128  # points of a small cell within a task

_NEAR = "d array<double>, label array<double>, n array<bigint>, pid array<bigint>"


class Cells:
    """Axis-parallel cells: a binary tree of (axis, cut) with the box of every leaf."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.axis: list[int] = []
        self.cut: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        dims = sample.shape[1]
        lows, highs = [], []

        def grow(rows: np.ndarray, want: int, low: np.ndarray, high: np.ndarray) -> int:
            node = len(self.axis)
            for store, empty in ((self.axis, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
                store.append(empty)
            spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(dims)
            if want < 2 or not spread.max() > 0:
                self.left[node] = len(lows)
                lows.append(low)
                highs.append(high)
                return node
            axis = int(spread.argmax())
            column = np.sort(rows[:, axis])
            cut = column[(len(column) - 1) // 2]
            if cut == column[-1]:  # keep the right side from being empty
                cut = column[column < cut][-1]
            inside = rows[:, axis] <= cut
            self.axis[node], self.cut[node] = axis, float(cut)
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = right_low[axis] = cut
            self.left[node] = grow(rows[inside], want // 2, low, left_high)
            self.right[node] = grow(rows[~inside], want - want // 2, right_low, high)
            return node

        grow(sample, leaves, np.full(dims, -np.inf), np.full(dims, np.inf))
        self.low, self.high = np.array(lows), np.array(highs)

    def to_dict(self) -> dict:
        """Plain lists; infinite box edges are written as None."""
        edge = lambda box: [[v if np.isfinite(v) else None for v in row] for row in box.tolist()]
        return {"axis": self.axis, "cut": self.cut, "left": self.left, "right": self.right,
                "low": edge(self.low), "high": edge(self.high)}

    @classmethod
    def from_dict(cls, parts: dict) -> Cells:
        cells = cls.__new__(cls)
        cells.axis, cells.cut, cells.left, cells.right = (parts[n] for n in ("axis", "cut", "left", "right"))
        fill = lambda box, empty: np.array([[empty if v is None else v for v in row] for row in box])
        cells.low, cells.high = fill(parts["low"], -np.inf), fill(parts["high"], np.inf)
        return cells

    @property
    def n_leaves(self) -> int:
        return len(self.low)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        axis, cut = np.array(self.axis), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = axis[node] >= 0
            if not inner.any():
                return left[node]
            at = node[inner]
            goes_left = x[inner, axis[at]] <= cut[at]
            node[inner] = np.where(goes_left, left[at], right[at])

    def within(self, x: np.ndarray, radius: np.ndarray) -> Iterator[np.ndarray]:
        """Per row: the leaves whose box comes within the radius."""
        block = max(1, BLOCK_CELLS // self.n_leaves)
        for start in range(0, len(x), block):
            some = slice(start, start + block)
            for near in _box_distance(x[some], self.low, self.high) <= radius[some, None]:
                yield np.flatnonzero(near)


def _distance(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances, queries by points, added up feature by feature."""
    d2 = np.zeros((len(q), len(p)))
    for a, b in zip(q.T, p.T):
        gap = a[:, None] - b[None, :]
        gap *= gap
        d2 += gap
    return d2


def _box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances, queries by boxes, added up as in ``_distance``, so never above that of a point inside."""
    d2 = np.zeros((len(q), len(low)))
    for a, least, most in zip(q.T, low.T, high.T):
        gap = a[:, None] - np.clip(a[:, None], least[None, :], most[None, :])
        gap *= gap
        d2 += gap
    return d2


_NONE = (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))


def _nearest(points: pd.DataFrame, queries: np.ndarray, radius: np.ndarray, k: int) -> list[tuple]:
    """Per query: up to k nearest training rows (squared distance, label, count, id) within its radius."""
    p = np.array(points["x"].tolist(), dtype=float)
    cells = Cells(p, -(-len(p) // CELL_ROWS))
    leaf = cells.leaf_of(p)
    order = np.argsort(leaf, kind="stable")
    p, leaf = p[order], leaf[order]
    label, n, pid = (points[c].to_numpy()[order] for c in ("label", "n", "pid"))
    bounds = np.append(np.flatnonzero(np.diff(leaf, prepend=-1)), len(p))
    spans = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    low, high = (np.array([edge(p[s], axis=0) for s in spans]) for edge in (np.min, np.max))
    block = max(1, BLOCK_CELLS // max(np.diff(bounds).max(), len(spans)))
    out: list[tuple] = []
    for start in range(0, len(queries), block):
        q, r = queries[start : start + block], radius[start : start + block].copy()
        gaps = _box_distance(q, low, high)
        # The k-th row of the closest cell bounds the radius.
        closest = np.where(np.diff(bounds)[gaps.argmin(axis=1)] >= k, gaps.argmin(axis=1), -1)
        for c, s in enumerate(spans):
            mine = np.flatnonzero(closest == c)
            if len(mine):
                r[mine] = np.minimum(r[mine], np.partition(_distance(q[mine], p[s]), k - 1, axis=1)[:, k - 1])
        held, found, size = _NONE, [], 0
        for c, s in enumerate(spans):
            mine = np.flatnonzero(gaps[:, c] <= r)
            if len(mine):
                d2 = _distance(q[mine], p[s])
                row, at = np.nonzero(d2 <= r[mine, None])
                found.append((mine[row], d2[row, at], at + s.start))
                size += len(row)
            if size > BLOCK_CELLS or c == len(spans) - 1:
                held, found, size = _first(held, found, pid, k), [], 0
        who, d2, at = held
        ends = np.searchsorted(who, np.arange(len(q) + 1))
        for a, b in zip(ends[:-1], ends[1:]):
            near = at[a:b]
            out.append((d2[a:b].tolist(), label[near].tolist(), n[near].tolist(), pid[near].tolist()))
    return out


def _first(held: tuple, found: list[tuple], pid: np.ndarray, k: int) -> tuple:
    """``(query, squared distance, row)`` of the k nearest rows of each query, by query, distance and id."""
    who, d2, at = (np.concatenate(parts) for parts in zip(held, *found))
    best = np.lexsort((pid[at], d2, who))
    who = who[best]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[keep], d2[best][keep], at[best][keep]


class KnnClassifier:
    """``weights`` is ``uniform`` or ``distance``; labels must be 0.0 and 1.0."""

    def __init__(self, k: int = 5, weights: str = "uniform", leaf_rows: int = LEAF_ROWS,
                 chunk_rows: int = CHUNK_ROWS, part_rows: int = PART_ROWS) -> None:
        if weights not in ("uniform", "distance"):
            raise ValueError(f"unknown weights {weights!r}")
        self.k, self.weights = k, weights
        self.leaf_rows, self.chunk_rows, self.part_rows = leaf_rows, chunk_rows, part_rows

    def fit(self, df: DataFrame) -> KnnModel:
        points = staged(
            df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
            .groupBy("x", "label")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pid", F.xxhash64("x", "label")),
            "knn",
        )
        rows = points.count()
        if not rows:
            raise ValueError("no training rows")
        leaves = max(1, min(MAX_LEAVES, -(-rows // self.leaf_rows)))
        # The ids are hashes of distinct rows: a remainder class is an even sample of known size.
        share = max(1, rows // (leaves * SAMPLES_PER_LEAF))
        sample = points.filter(F.pmod("pid", F.lit(share)) == 0).select("x").collect()
        if not sample:
            sample = points.select("x").limit(1).collect()
        cells = Cells(np.array([r["x"] for r in sample], dtype=float), leaves)
        return KnnModel(self, points, cells)


class KnnModel:
    def __init__(self, settings: KnnClassifier, points: DataFrame, cells: Cells) -> None:
        self.settings, self.cells, self.rows = settings, cells, points
        self.points = points.withColumn("leaf", self._leaf()("x"))
        self.parts = self.points.groupBy("leaf").agg(
            F.ceil(F.count(F.lit(1)) / settings.part_rows).alias("parts")
        )

    def _leaf(self):
        cells = self.cells

        @F.pandas_udf(T.IntegerType())
        def leaf(x: pd.Series) -> pd.Series:
            return pd.Series(cells.leaf_of(np.array(x.tolist(), dtype=float)), index=x.index)

        return leaf

    def _others(self):
        cells = self.cells

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def others(x: pd.Series, radius: pd.Series, home: pd.Series) -> pd.Series:
            found = cells.within(np.array(x.tolist(), dtype=float), radius.to_numpy())
            return pd.Series([f[f != h].tolist() for f, h in zip(found, home)], index=x.index)

        return others

    def _visit(self, queries: DataFrame) -> DataFrame:
        """``queries`` (x, leaf, radius) against the points of their leaf."""
        k = self.settings.k
        per_leaf = queries.groupBy("leaf").agg(
            F.ceil(F.count(F.lit(1)) / self.settings.chunk_rows).alias("chunks")
        )
        # At most MAX_LEAVES rows; a leaf without points still answers, with nothing.
        plan = F.broadcast(
            per_leaf.join(self.parts, "leaf", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        )
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        asked = queries.join(plan, "leaf").withColumn("chunk", F.pmod(F.xxhash64("x"), "chunks")).withColumn(
            "part", upto("parts")
        )
        offered = self.points.join(plan, "leaf").withColumn("part", F.pmod("pid", "parts")).withColumn(
            "chunk", upto("chunks")
        )

        def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
            if q.empty or p.empty:
                return pd.DataFrame({"x": q["x"], **{c: [[] for _ in range(len(q))] for c in ("d", "label", "n", "pid")}})
            found = _nearest(p, np.array(q["x"].tolist(), dtype=float), q["radius"].to_numpy(), k)
            d, label, n, pid = zip(*found)
            return pd.DataFrame({"x": q["x"].to_numpy(), "d": d, "label": label, "n": n, "pid": pid})

        groups = ("leaf", "chunk", "part")
        return (
            asked.select("x", "radius", *groups).groupBy(*groups)
            .cogroup(offered.select("x", "label", "n", "pid", *groups).groupBy(*groups))
            .applyInPandas(meet, f"x array<double>, {_NEAR}")
        )

    def neighbours(self, points: DataFrame) -> DataFrame:
        """Distinct query points ``x`` with their nearest rows, sorted by distance then id."""
        k = self.settings.k
        home = points.select("x").distinct().withColumn("leaf", self._leaf()("x"))
        inf = F.lit(float("inf"))
        first = staged(self._best(self._visit(home.withColumn("radius", inf))), "knn-home")
        # Squared distance at which the counts reach k; infinite while they do not.
        reach = F.aggregate(
            "near",
            F.struct(F.lit(0).cast("long").alias("seen"), inf.alias("at")),
            lambda acc, r: F.when(acc["seen"] >= k, acc).otherwise(
                F.struct((acc["seen"] + r["n"]).alias("seen"),
                         F.when(acc["seen"] + r["n"] >= k, r["d"]).otherwise(inf).alias("at"))
            ),
            lambda acc: acc["at"],
        )
        reached = first.withColumns({"radius": reach, "home": self._leaf()("x")})
        more = reached.select("x", "radius", F.explode(self._others()("x", "radius", "home")).alias("leaf"))
        return self._best(self._visit(more), first)

    def _best(self, visited: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
        """``(x, near)``: the k nearest over all visits; a query makes a bounded number of them."""
        zipped = F.transform(
            F.arrays_zip("d", "pid", "label", "n"),
            lambda r: F.struct(r["d"].alias("d"), r["pid"].alias("pid"), r["label"].alias("label"), r["n"].alias("n")),
        )
        found = visited.select("x", zipped.alias("near"))
        if earlier is not None:
            found = earlier.select("x", "near").unionByName(found)
        return found.groupBy("x").agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, self.settings.k).alias("near")
        )

    def with_neighbours(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_x``, its point, and ``near``, its nearest rows."""
        queries = df.withColumn("_x", vector_to_array("features"))
        near = self.neighbours(queries.select(F.col("_x").alias("x"))).withColumnRenamed("x", "_x")
        return queries.join(near, "_x", "left")

    def transform(self, df: DataFrame) -> DataFrame:
        queries = df.withColumn("_x", vector_to_array("features"))
        near = self.neighbours(queries.select(F.col("_x").alias("x")))
        scored = near.select(F.col("x").alias("_x"), vote_of(self.settings.k, self.settings.weights).alias("probability_one"))
        return (
            queries.join(scored, "_x", "left")
            .withColumn("prediction", (F.col("probability_one") > 0.5).cast("double"))
            .drop("_x", "probability_one")
        )


def vote_of(k: int, weights: str):
    """The share of label one among the first ``k`` rows of ``near``, which counts equal rows."""
    if weights == "uniform":
        weight = lambda r: F.lit(1.0)
    else:
        # Rows at distance zero outvote all others.
        exact = F.get("near", F.lit(0))["d"] == 0
        weight = lambda r: F.when(exact, (r["d"] == 0).cast("double")).otherwise(1 / F.sqrt(r["d"]))
    take = lambda acc, r: F.least(F.lit(k).cast("long") - acc["seen"], r["n"])
    return F.aggregate(
        "near",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("ones"), F.lit(0.0).alias("all")),
        lambda acc, r: F.struct(
            (acc["seen"] + take(acc, r)).alias("seen"),
            (acc["ones"] + F.when(take(acc, r) > 0, take(acc, r) * weight(r) * r["label"]).otherwise(0.0)).alias("ones"),
            (acc["all"] + F.when(take(acc, r) > 0, take(acc, r) * weight(r)).otherwise(0.0)).alias("all"),
        ),
        lambda acc: acc["ones"] / acc["all"],
    )
