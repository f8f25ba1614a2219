"""Extremely randomised trees against a plain Python version with the same draws."""

import os

import numpy as np
import pytest

from lodgeworks.operators import extratrees
from lodgeworks.operators.extratrees import draws, extra_trees_importance
from lodgeworks.session import discard, shared_dir


def plain_importance(x, y, trees, seed, depth=None, tried=2, least=2):
    """Node by node, in level order."""
    n, width = x.shape
    total = np.zeros(width)
    impurity = lambda rows: 2 * y[rows].sum() * (len(rows) - y[rows].sum()) / len(rows) if len(rows) else 0.0
    u = lambda t, k, f, use: float(draws(seed, np.array([t]), np.array([k]), np.array([f]), use)[0])
    for t in range(trees):
        gains = np.zeros(width)
        open_, number, level = [(0, np.arange(n))], 1, 0
        while open_ and (depth is None or level < depth):
            following = []
            for node, rows in open_:
                if y[rows].min() == y[rows].max() or len(rows) < least:
                    continue
                order = sorted(range(width), key=lambda f: (u(t, node, f, 0), f))
                best = None
                for first in range(0, width, tried):
                    for f in order[first : first + tried]:
                        low, high = x[rows, f].min(), x[rows, f].max()
                        cut = low + u(t, node, f, 1) * (high - low)
                        if not (low < high and cut < high):
                            continue
                        left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                        gain = (impurity(rows) - impurity(left) - impurity(right)) / n
                        if best is None or gain > best[0] * (1 + 1e-9) + 1e-15:
                            best = (gain, f, left, right)
                    if best is not None:
                        break
                if best is None or best[0] <= 1e-15:
                    continue
                gains[best[1]] += best[0]
                following += [(number, best[2]), (number + 1, best[3])]
                number += 2
            open_, level = following, level + 1
        if gains.sum():
            total += gains / gains.sum()
    return total / total.sum()


def sample(n=300):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.random(n), rng.integers(0, 3, n), np.ones(n), rng.normal(size=n).round(1), rng.integers(0, 2, n)])
    y = ((x[:, 0] > 0.6) | (rng.random(n) < 0.2)).astype(float)
    return np.vstack([x, x[:40]]), np.r_[y, y[:40]]  # repeated rows


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, e double, label double")


@pytest.mark.parametrize("depth, least, small", [(None, 2, False), (3, 2, False), (None, 20, True)])
def test_importance_equals_a_plain_version(spark, monkeypatch, depth, least, small):
    if small:  # many tasks, many chunks, rows written at every level
        for name, value in (("TASK_ROWS", 30), ("PASS_BYTES", 32 * 7), ("CUT_LEVELS", 1), ("DIRECT_TASKS", 2)):
            monkeypatch.setattr(extratrees, name, value)
    x, y = sample(300 if not small else 90)
    found = extra_trees_importance(frame(spark, x, y), "abcde", trees=3, seed=5, depth=depth, least_rows=least)
    got = [r.importance for r in found.collect()]
    assert np.allclose(got, plain_importance(x, y, 3, 5, depth, 2, least), atol=1e-12)
    assert got[2] == 0 and abs(sum(got) - 1) < 1e-12 and got[0] == max(got)


def test_draws_are_uniform_and_depend_on_all_arguments():
    t, k, f = np.meshgrid(np.arange(20), np.arange(50), np.arange(10), indexing="ij")
    u = draws(3, t, k, f, 0)
    assert abs(u.mean() - 0.5) < 0.01 and np.unique(u).size == u.size and (draws(3, t, k, f, 1) != u).all()
    assert abs(np.corrcoef(u[:, :, 0].ravel(), u[:, :, 1].ravel())[0, 1]) < 0.08


def test_trees_without_a_split(spark):
    ones = frame(spark, np.ones((5, 5)), [0, 1, 0, 1, 0])
    assert [r.importance for r in extra_trees_importance(ones, "abcde").collect()] == [0.0] * 5
    with pytest.raises(ValueError, match="no rows"):
        extra_trees_importance(ones.limit(0), "abcde")
    with pytest.raises(ValueError, match="null"):
        extra_trees_importance(ones.selectExpr("IF(label = 1, NULL, a) AS a", "b", "label"), "ab")
    with pytest.raises(ValueError, match="null"):
        extra_trees_importance(ones.selectExpr("a", "label + 1 AS label"), "a")


def test_blocks_of_few_rows_give_the_same(spark, monkeypatch):
    """Rows read by the block: many small blocks in few tasks."""
    monkeypatch.setattr(extratrees, "BLOCK_ROWS", 7)
    x, y = sample(60)
    got = [r.importance for r in extra_trees_importance(frame(spark, x, y), "abcde", trees=2, seed=5).collect()]
    assert np.allclose(got, plain_importance(x, y, 2, 5), atol=1e-12)


def test_trees_grow_in_groups_and_leave_no_rows(spark, monkeypatch):
    """One tree at a time, rows written at every level: the same result, short slots, and no blocks left in the shared folder."""
    for name, value in (("HAND", 1), ("BLOCK_ROWS", 7), ("FILE_BLOCKS", 2), ("CUT_LEVELS", 1)):
        monkeypatch.setattr(extratrees, name, value)
    kinds, blocks = [], extratrees.Blocks
    monkeypatch.setattr(extratrees, "Blocks", lambda *a: kinds.append((a[3], a[4])) or blocks(*a))
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    x, y = sample(60)
    got = [r.importance for r in extra_trees_importance(frame(spark, x, y), "abcde", trees=3, seed=5).collect()]
    assert np.allclose(got, plain_importance(x, y, 3, 5), atol=1e-12)
    assert set(kinds) == {(1, np.int16)} and not [f for f in set(os.listdir(folder)) - before if f.startswith(("trees", "cells"))]


def test_only_staged_files_are_discarded(spark, tmp_path):
    path = str(tmp_path / "mine")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="staged"):
        discard(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3
