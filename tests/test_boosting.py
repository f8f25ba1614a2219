"""Boosted trees against plain Python versions of the same rules."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import boosting
from lodgeworks.operators.boosting import Bins, Boost, BoostedModel, BoostedTrees, binned_rows, fit_bins, grow
from lodgeworks.session import shared_dir


def table(spark, x, y, **more):
    rows = [(i, [None if v is None else float(v) for v in r], float(l), *[more[c][i] for c in more]) for i, (r, l) in enumerate(zip(x, y))]
    names = "".join(f", {c} int" for c in more)
    df = spark.createDataFrame(rows, f"id long, features array<double>, label double{names}")
    return df.withColumn("features", F.transform("features", lambda v: F.coalesce(v, F.lit(float("nan")))))


def sample(rng, n, missing=0.0):
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[:, 2] = rng.integers(0, 4, n)
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.8) | (x[:, 2] == 2) & (rng.random(n) < 0.7)).astype(float)
    if missing:
        x[rng.random(x.shape) < missing] = np.nan
    return x, y


def cuts_of(x):
    return [np.unique(c[~np.isnan(c)]) for c in x.T]


def plain_boost(x, y, model, columns=lambda t: None):
    """One row at a time over midpoints of distinct values; returns raw scores and the trees as nested tuples."""
    values = cuts_of(x)
    n, width = x.shape
    raw = np.zeros(n)
    if model.kind == "gradient":
        raw += math.log(y.sum() / (n - y.sum()))
    trees, gains = [], np.zeros(width)

    def stats(rows, g, h):
        return g[rows].sum(), h[rows].sum()

    def score(a, b):
        return a * a / (b + model.penalty)

    def split(rows, g, h):
        best = None
        for f in range(width):
            col = x[rows, f]
            for a, b in zip(values[f], [*values[f][1:], np.inf]):
                cut = (a + b) / 2
                for low in (True, False) if np.isnan(col).any() else (True,):
                    left = rows[np.where(np.isnan(col), low, col <= cut)]
                    right = rows[~np.where(np.isnan(col), low, col <= cut)]
                    if not (col <= cut).any() or not len(right) or min(len(left), len(right)) < model.min_leaf:
                        continue
                    (ga, ha), (gb, hb) = stats(left, g, h), stats(right, g, h)
                    if model.kind == "second_order":
                        if ha < model.least_hessian or hb < model.least_hessian:
                            continue
                        gain = (score(ga, ha) + score(gb, hb) - score(ga + gb, ha + hb)) / 2 - model.least_gain
                    elif model.kind == "gradient":
                        gain = len(left) * len(right) / len(rows) * (ga / len(left) - gb / len(right)) ** 2
                    else:
                        gini = lambda p, q: 2 * p * q / (p + q)
                        gain = (gini(ga + gb, ha + hb) - gini(ga, ha) - gini(gb, hb)) / (ga + gb + ha + hb)
                    if best is None or gain > best[0] * (1 + 1e-9) + 1e-15:
                        best = (gain, f, cut, low, left, right)
        return best if best and best[0] > 1e-12 else None

    def build(rows, g, h, depth, out):
        found = split(rows, g, h) if depth < model.depth else None
        if found is None:
            a, b = stats(rows, g, h)
            if model.kind == "second_order":
                out[rows] = -a / (b + model.penalty)
            elif model.kind == "gradient":
                out[rows] = a / b
            else:
                out[rows] = 1.0 if a > b else -1.0
            return
        gains[found[1]] += found[0]
        trees.append(found[1:3])
        build(found[4], g, h, depth + 1, out)
        build(found[5], g, h, depth + 1, out)

    for _ in range(model.rounds):
        if model.kind == "stumps":
            w = np.exp(-(2 * y - 1) * raw / 2)
            g, h = w * y, w * (1 - y)
        else:
            p = 1 / (1 + np.exp(-raw))
            g, h = (p - y if model.kind == "second_order" else y - p), p * (1 - p)
        out = np.zeros(n)
        build(np.arange(n), g, h, 0, out)
        if model.kind == "stumps":
            bad = w[(out > 0) != (y > 0)].sum() / w.sum()
            if bad >= 0.5:
                break
            raw = raw + out * (1.0 if bad <= 0 else model.step * math.log((1 - bad) / bad))
            if bad <= 0:
                break
        else:
            raw = raw + model.step * out
    return raw, trees, gains


def raw_of(model, df, n):
    got = model.transform(df).select("id", "probability_one", "prediction").collect()
    raw = np.zeros(n)
    for r in got:
        raw[r.id] = math.log(r.probability_one / (1 - r.probability_one))
        assert r.prediction == float(raw[r.id] > 0)
    return raw


@pytest.mark.parametrize("model, missing", [
    (Boost(rounds=6, depth=3, step=0.3), 0.0), (Boost(rounds=4, depth=4, step=0.5, penalty=3.0, least_gain=0.05, least_hessian=2.0), 0.2),
    (Boost("gradient", rounds=5, depth=3, step=0.1, min_leaf=3), 0.0), (Boost("gradient", rounds=3, depth=40, step=0.5), 0.1),
    (Boost("stumps", rounds=12, depth=1, step=1.0), 0.0), (Boost("stumps", rounds=8, depth=1, step=0.4), 0.15)])
def test_trees_equal_a_plain_version(spark, model, missing):
    x, y = sample(np.random.default_rng(4), 240, missing)
    df = table(spark, np.where(np.isnan(x), None, x), y)
    want, _, gains = plain_boost(x, y, model)
    fitted = BoostedTrees(model).fit(df)
    assert np.allclose(raw_of(fitted, df, 240), want, atol=1e-7)
    assert np.allclose(fitted.importance(), gains / gains.sum(), atol=1e-7)


def test_stumps_equal_brute_force_on_2000_rows(spark):
    """Stumps and votes of 50 rounds against every threshold of every feature tried anew."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 400, 2_000), np.round(rng.random(2_000) * 300, 1), rng.integers(1, 13, 2_000)]).astype(float)
    y = ((x[:, 0] > 180) & (x[:, 1] > 150) | (rng.random(2_000) < 0.1)).astype(float)
    w, want = np.ones(2_000), []
    order = [np.argsort(x[:, f], kind="stable") for f in range(3)]
    for _ in range(50):
        best = None
        for f in range(3):
            v, a, b = x[order[f], f], np.cumsum((w * y)[order[f]]), np.cumsum((w * (1 - y))[order[f]])
            ends = np.flatnonzero(v[1:] > v[:-1])
            part = lambda p, q: 2 * p * q / (p + q)
            gain = (part(a[-1], b[-1]) - part(a[ends], b[ends]) - part(a[-1] - a[ends], b[-1] - b[ends])) / w.sum()
            i = int(gain.argmax())
            if best is None or gain[i] > best[0] * (1 + 1e-9) + 1e-15:
                best = (gain[i], f, (v[ends[i]] + v[ends[i] + 1]) / 2, a[ends[i]] > b[ends[i]], a[-1] - a[ends[i]] > b[-1] - b[ends[i]])
        _, f, cut, left, right = best
        guess = np.where(x[:, f] <= cut, left, right)
        error = w[guess != y].sum() / w.sum()
        if error >= 0.5:
            break
        vote = math.log((1 - error) / error)
        want.append((f, cut, vote))
        w = w * np.where(guess != y, math.exp(vote), 1.0)
        w /= w.mean()
    model = BoostedTrees(Boost("stumps", rounds=50, depth=1, step=1.0), max_bins=4_096).fit(table(spark, x, y))
    got = [(t.feature[0], model.bins.cuts[t.feature[0]][t.cut[0]], max(map(abs, t.value))) for t in model.trees]
    assert [g[0] for g in got] == [g[0] for g in want]
    assert np.allclose([g[1:] for g in got], [g[1:] for g in want], atol=1e-6)


def test_many_paths_equal_single_ones(spark, monkeypatch):
    """Folds and parameters in one pass, with the scores written every other round, against separate fits."""
    rng = np.random.default_rng(5)
    x, y = sample(rng, 400)
    folds = rng.integers(0, 3, 400).tolist()
    df = table(spark, x, y, fold=folds)
    bins = fit_bins(df)
    models = [(Boost(rounds=5, depth=3), 0), (Boost(rounds=3, depth=5, step=0.1), 1), (Boost("gradient", rounds=4, depth=2, step=0.3), 2),
              (Boost("stumps", rounds=6, depth=1, step=0.5), None)]
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    monkeypatch.setattr(boosting, "TASK_ROWS", 40)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 3)
    monkeypatch.setattr(boosting, "PASS_BYTES", 5 * bins.size * 3 * 3 * 8)
    together = grow(binned_rows(df, bins, fold="fold"), bins, models)
    for path, (model, left_out) in zip(together, models):
        part = df if left_out is None else df.filter(F.col("fold") != left_out)
        alone = grow(binned_rows(part, bins), bins, [(model, None)])[0]
        a, b = BoostedModel.of(path, bins), BoostedModel.of(alone, bins)
        assert len(a.trees) == model.rounds and np.allclose(a.raw(x), b.raw(x))
        assert np.allclose(BoostedModel.of(path, bins, 2).raw(x), BoostedModel.of(alone, bins, 2).raw(x))


def test_shares_of_rows_and_columns(spark):
    x, y = sample(np.random.default_rng(6), 600)
    df = table(spark, x, y)
    model = Boost(rounds=8, depth=3, row_share=0.6, column_share=0.4)
    first, again = (BoostedTrees(model, key="id").fit(d) for d in (df, df.repartition(5)))
    assert np.allclose(first.raw(x), again.raw(x)) and all(len(set(f for f in t.feature if f >= 0)) <= 1 for t in first.trees)
    kept = boosting._kept(np.arange(20_000, dtype=np.int64), 1, 3, 0.6)
    assert abs(kept.mean() - 0.6) < 0.02 and (kept != boosting._kept(np.arange(20_000, dtype=np.int64), 1, 4, 0.6)).mean() > 0.3


def test_bins_of_many_values(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.random(3_000), np.where(rng.random(3_000) < 0.4, 5.0, rng.random(3_000)), rng.integers(0, 9, 3_000)])
    bins = fit_bins(table(spark, x, np.zeros(3_000)), max_bins=20)
    codes = bins.codes(x)
    counts = np.bincount(codes[:, 0])
    assert len(counts) == 20 and counts.max() <= 151 and counts.min() >= 149
    assert codes[:, 1].max() < 20 and [len(c) for c in bins.cuts][2] == 8 and bins.codes(np.array([[np.nan] * 3])).tolist() == [[bins.missing] * 3]


def test_a_hot_row_is_one_row(spark):
    x = np.vstack([np.tile([1.0, 2.0, 3.0], (500, 1)), np.random.default_rng(1).random((100, 3))])
    y = np.r_[np.ones(500), np.zeros(50), np.ones(50)]
    df = table(spark, x, y)
    rows = binned_rows(df, fit_bins(df))
    assert rows.count() <= 101 and rows.agg(F.sum("n")).first()[0] == 600


def test_unusable_input(spark):
    with pytest.raises(ValueError):
        Boost("other")
    with pytest.raises(ValueError):
        Boost(rounds=0)
    with pytest.raises(ValueError):
        fit_bins(table(spark, [], []))
    same = table(spark, [[1.0, 2.0, 3.0]] * 10, [0.0, 1.0] * 5)
    with pytest.raises(ValueError, match="chance"):
        BoostedTrees(Boost("stumps", depth=1)).fit(same)
    with pytest.raises(ValueError, match="labels"):
        BoostedTrees(Boost("gradient")).fit(table(spark, [[1.0, 2.0, 3.0]] * 4, [1.0] * 4))


def test_saved_trees_score_alike(spark, tmp_path):
    x, y = sample(np.random.default_rng(3), 200)
    df = table(spark, x, y)
    model = BoostedTrees(Boost(rounds=3, depth=3)).fit(df)
    meta = model.save(spark, str(tmp_path))
    again = BoostedModel.load(spark, str(tmp_path), meta)
    assert np.array_equal(again.raw(x), model.raw(x)) and again.importance() == model.importance() and isinstance(again.bins, Bins)


def test_look_ups_find_the_leaves_of_a_walk():
    """Trees of one leaf, of up to 64 leaves and of more; the last bin is that of missing values."""
    rng = np.random.default_rng(9)
    codes = rng.integers(0, 20, (4, 3_000)).astype(np.uint8)
    for splits in (0, 1, 5, 63, 64, 90):
        tree = boosting.Tree()
        for _ in range(splits):
            leaf = rng.choice([i for i, f in enumerate(tree.feature) if f < 0])
            tree.grow(int(leaf), int(rng.integers(4)), int(rng.integers(19)), bool(rng.integers(2)))
        tree.value = rng.normal(size=len(tree.value)).tolist()
        assert np.array_equal(tree.finder(20)(codes), tree.leaf_of(codes.T, 19))
        assert np.array_equal(tree.scorer(20)(codes), tree.scores(codes.T, 19))


def test_stumps_keep_no_scores_with_the_rows(spark, monkeypatch):
    """What a search over stumps writes does not grow with its paths and rounds."""
    x, y = sample(np.random.default_rng(8), 300)
    df = table(spark, x, y)
    bins = fit_bins(df)
    rows = binned_rows(df, bins)
    monkeypatch.setattr(boosting, "CUT_EVERY", 1)
    monkeypatch.setattr(boosting, "staged", lambda *_: pytest.fail("scores were written"))
    path = grow(rows, bins, [(Boost("stumps", rounds=5, depth=1, step=0.5), None)])[0]
    assert len(path.trees) == 5


def test_a_pass_needs_no_plan(spark, monkeypatch):
    x, y = sample(np.random.default_rng(5), 400)
    df = table(spark, x, y)
    bins = fit_bins(df)
    rows = binned_rows(df, bins)
    planned = []
    frame = type(rows)
    monkeypatch.setattr(frame, "mapInArrow", lambda *a, f=frame.mapInArrow, **k: planned.append(1) or f(*a, **k))
    path, = grow(rows, bins, [(Boost("second_order", rounds=4, depth=3), None)])
    assert len(path.trees) == 4 and not planned


def test_tables_of_many_tasks_add_up_by_salt(spark, monkeypatch):
    x, y = sample(np.random.default_rng(6), 600)
    df = table(spark, x, y)
    bins = fit_bins(df)
    rows = binned_rows(df, bins).repartition(5).localCheckpoint()
    models = [(Boost("second_order", rounds=3, depth=3), None), (Boost("gradient", rounds=3, depth=2, step=0.1), None)]
    want = grow(rows, bins, models)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 2)
    for a, b in zip(want, grow(rows, bins, models)):
        assert [(t.feature, t.cut) for t in a.trees] == [(t.feature, t.cut) for t in b.trees]
        assert np.allclose([v for t in a.trees for v in t.value], [v for t in b.trees for v in t.value])


def test_replaced_scores_are_discarded(spark, monkeypatch):
    """Only the binned rows stay; the files of scores go when newer ones are written."""
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    x, y = sample(np.random.default_rng(3), 200)
    BoostedTrees(Boost(rounds=7, depth=2)).fit(table(spark, x, y))
    left = set(os.listdir(folder)) - before
    assert sorted(f.split("-")[0] for f in left if f.startswith(("scores", "binned"))) == ["binned"]
