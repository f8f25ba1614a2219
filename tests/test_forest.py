"""The random forest against a plain Python version with the same draws."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from lodgeworks.operators import forest, models
from lodgeworks.operators.boosting import Bins
from lodgeworks.operators.extratrees import draws
from lodgeworks.operators.forest import Forest, ForestModel, RandomForest, picked_cuts
from lodgeworks.operators.persistence import load_model, save_model


def sample(n=400):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 3, n), np.ones(n), rng.integers(0, 6, n), rng.integers(0, 2, n)]).astype(float)
    y = (((x[:, 0] > 3) & (x[:, 3] < 4)) | (rng.random(n) < 0.15)).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(Vectors.dense(r.tolist()), float(v)) for r, v in zip(x, y)], ["features", "label"])


def plain_scores(bins, x, y, settings):
    """Mean vote of every row of ``x``; nodes are numbered level by level, all trees together."""
    codes = bins.codes(x)
    cells = sorted({(c.astype(np.uint16).tobytes(), v) for c, v in zip(codes, y)})
    seen = [(c.astype(np.uint16).tobytes(), v) for c, v in zip(codes, y)]
    n = np.array([seen.count(c) for c in cells])
    cell = np.array([np.frombuffer(c, dtype=np.uint16) for c, _ in cells]).astype(int)
    label = np.array([v for _, v in cells]).astype(int)
    weight = np.random.default_rng([settings.seed, 0]).poisson(n, (settings.trees, len(cells)))
    width = x.shape[1]
    tried = math.ceil(math.sqrt(width))

    def impurity(k):
        if k.sum() == 0:
            return 0.0
        p = k / k.sum()
        return k.sum() * ((p * (1 - p)).sum() if settings.impurity == "gini" else -sum(v * math.log2(v) for v in p if v))

    of = lambda t, rows: np.bincount(label[rows], weight[t][rows], 2)
    everything = np.arange(len(cells))
    nodes = [{"t": t, "rows": everything, "level": 0, "split": None} for t in range(settings.trees)]
    i = 0
    while i < len(nodes):
        node = nodes[i]
        t, rows = node["t"], node["rows"]
        node["k"] = total = of(t, rows)
        if total.min() > 0 and node["level"] < settings.depth:
            rank = draws(settings.seed, np.zeros(width, int), np.full(width, i), np.arange(width), 0)
            tried_splits = []
            for f in np.argsort(rank, kind="stable")[:tried]:
                for cut in range(bins.size - 1):
                    a, b = rows[cell[rows, f] <= cut], rows[cell[rows, f] > cut]
                    ka, kb = of(t, a), of(t, b)
                    if min(ka.sum(), kb.sum()) < settings.min_leaf:
                        continue
                    tried_splits.append((impurity(total) - impurity(ka) - impurity(kb), f, cut, a, b))
            most = max((s[0] for s in tried_splits), default=0.0)
            if most > 1e-9:
                best = next(s for s in tried_splits if s[0] >= most - 1e-10)
                node["split"] = (best[1], best[2], len(nodes))
                nodes += [{"t": t, "rows": r, "level": node["level"] + 1, "split": None} for r in best[3:]]
        i += 1
    for node in reversed(nodes):
        if node["split"]:
            a, b = nodes[node["split"][2]], nodes[node["split"][2] + 1]
            if not a["split"] and not b["split"] and (a["k"][1] > a["k"][0]) == (b["k"][1] > b["k"][0]):
                node["split"] = None

    def vote(t, c):
        node = nodes[t]
        while node["split"]:
            f, cut, left = node["split"]
            node = nodes[left + (c[f] > cut)]
        return node["k"][1] / node["k"].sum()

    return np.array([np.mean([vote(t, c) for t in range(settings.trees)]) for c in codes])


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("settings", [Forest(4, 6, 3), Forest(3, 4, 8, min_leaf=9, impurity="entropy"), Forest(5, 1)])
def test_forest_equals_a_plain_version(spark, monkeypatch, small, settings):
    if small:  # many runs of nodes, sorted sums, cells kept at every level, rows scored on their own
        for name, value in (("RUN_BYTES", 1), ("TABLE_BYTES", 0), ("SORTED", 50), ("CUT_LEVELS", 1), ("GRID_CELLS", 1)):
            monkeypatch.setattr(forest, name, value)
    x, y = sample(250)
    df = frame(spark, x, y)
    model = RandomForest(settings).fit(df)
    expected = plain_scores(model.bins, x, y, settings)
    got = model.transform(df).collect()
    assert np.allclose([r.probability_one for r in got], expected, atol=1e-9)
    assert [r.prediction for r in got] == [float(r.probability_one > 0.5) for r in got]
    assert np.allclose(model.scores(x), model.scores(x, model.grid()))


def test_a_pass_reads_cells_not_rows(spark):
    """Fifty times the rows are as many cells; their counts make up the rows."""
    x, y = sample()
    many = frame(spark, np.tile(x, (50, 1)), np.tile(y, 50))
    bins = forest.class_bins(many, "features", "label", 32)
    blocks = forest._blocks(many, bins, Forest(), "features", "label")[0].collect()
    cells = len({(*r, v) for r, v in zip(x.tolist(), y)})
    assert sum(len(b.n) for b in blocks) == cells < len(x) and sum(b.n.sum() for b in blocks) == 50 * len(x)


def test_the_forest_depends_on_the_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_PAIRS", 200)  # many blocks
    x, y = sample()
    df = frame(spark, x, y)
    one, other = (RandomForest(Forest(10, 8)).fit(rows) for rows in (df.coalesce(1), df.repartition(7)))
    assert all((getattr(one, name) == getattr(other, name)).all() for name in ("feature", "cut", "left", "value"))


def test_few_bins_part_the_classes(spark):
    """A threshold that lies between equal shares of the rows has a cut of its own."""
    counts = np.zeros((1000, 2))
    counts[:777, 0], counts[777:, 1] = 3, 3
    cuts = picked_cuts(counts, 31)
    assert 776 in cuts and len(cuts) <= 31 and np.diff(cuts).max() < 1000 / 25
    assert picked_cuts(counts[:32], 31) == list(range(31))
    rng = np.random.default_rng(1)
    x = rng.random((3000, 2)).round(4)
    y = ((x[:, 0] > 0.4321) & (x[:, 1] > 0.5678)).astype(float)
    df = frame(spark, x, y)
    model = RandomForest(Forest(20, 8)).fit(df)
    assert max(len(c) for c in model.bins.cuts) < 32
    assert np.mean([r.prediction == r.label for r in model.transform(df).collect()]) > 0.998


def test_forest_survives_saving(spark, tmp_path):
    x, y = sample()
    model = RandomForest(Forest(5, 5)).fit(frame(spark, x, y))
    save_model(spark, model, str(tmp_path))
    again = load_model(spark, str(tmp_path))
    assert (again.scores(x) == model.scores(x)).all() and again.uid == model.uid and again.bins == model.bins


def test_odd_rows(spark):
    x, y = sample(60)
    ones = RandomForest(Forest(3, 4)).fit(frame(spark, x, np.ones(60)))
    assert ones.total_nodes == 3 and [r.prediction for r in ones.transform(frame(spark, x, y)).collect()] == [1.0] * 60
    same = RandomForest(Forest(3, 4)).fit(frame(spark, np.ones((60, 5)), y))
    assert same.total_nodes == 3
    assert RandomForest(Forest(3, 0)).fit(frame(spark, x, y)).total_nodes == 3
    with pytest.raises(ValueError, match="empty"):
        RandomForest(Forest()).fit(frame(spark, x, y).limit(0))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        RandomForest(Forest()).fit(frame(spark, x, y + 1))
    with pytest.raises(ValueError):
        Forest(impurity="other")
    missing = ForestModel(Bins(((0.5,),)), 1, np.array([0, -1, -1]), np.array([0, 0, 0]), np.array([1, -1, -1]), np.array([0.5, 0.0, 1.0]))
    at = np.array([[0.0], [1.0], [np.nan]])
    assert missing.scores(at).tolist() == missing.scores(at, missing.grid()).tolist() == [0.0, 1.0, 1.0]


def test_many_rows_are_fitted_over_cells(spark, monkeypatch):
    """Few rows keep the forest of Spark ML."""
    x, y = sample()
    df, classifier = frame(spark, x, y), models.presets(["a"], "k")["random_forest"].make(trees=5, depth=4)
    assert type(classifier.fit(df)).__name__ == "RandomForestClassificationModel"
    monkeypatch.setattr(models, "FOREST_ROWS", 399)
    model = classifier.fit(df)
    assert isinstance(model, ForestModel) and model.trees == 5
    assert {r.prediction for r in model.transform(df).collect()} == {0.0, 1.0}
