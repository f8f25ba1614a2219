import threading
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodgeworks.operators import knn, models, tuning
from lodgeworks.operators.knn import Cells, KnnClassifier
from lodgeworks.operators.split import TRAIN_TEST, add_fold, add_split, fit_scaler
from lodgeworks.plans import train as training


# Sizes that suit a few hundred rows; the presets themselves run in the catalog.
QUICK = {
    "random_forest": {"trees": 20, "depth": 8}, "gradient_boosting": {"rounds": 10}, "xgboost": {"rounds": 10, "depth": 4},
    "ada_boost": {"rounds": 5}, "svc": {"dims": 32, "max_iter": 20},
}


def quick(prepared):
    """``QUICK`` with the same sizes for the base models of the stack."""
    options = models.presets(prepared.scaler.outputs, prepared.key)
    base = {n: partial(p.make, **QUICK.get(n, {})) for n, p in options.items() if n != "stacked_clf"}
    return {**QUICK, "stacked_clf": {"base": base}}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(1_500).select(
        F.col("id").alias("booking_id"),
        (F.rand(1) * 400).alias("lead_time"),
        (F.rand(2) * 300).alias("avg_price_per_room"),
        F.floor(F.rand(3) * 5).alias("no_of_special_requests"),
        F.floor(F.rand(4) * 28 + 1).alias("arrival_date"),
        F.floor(F.rand(5) * 12 + 1).alias("arrival_month"),
    )
    return df.withColumn("y", ((F.col("lead_time") > 200) & (F.col("avg_price_per_room") > 100)).cast("int")).cache()


@pytest.fixture(scope="module")
def prepared(rows):
    return training.prepare(rows, "y")


def test_split_is_disjoint_complete_and_stable(spark):
    df = add_split(spark.range(15_000), "id")
    sizes = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 15_000
    assert abs(sizes["train"] / 15_000 - 0.70) < 0.02 and abs(sizes["test"] / 15_000 - 0.09) < 0.02
    moved = add_split(spark.range(15_000).repartition(7), "id")
    assert df.exceptAll(moved).isEmpty()
    two = add_split(spark.range(1_000), "id", TRAIN_TEST).filter("split = 'train'").count()
    assert abs(two - 800) < 50
    with pytest.raises(ValueError):
        add_split(df, "id", (("a", 500),))
    assert {r.fold for r in add_fold(spark.range(500), "id", 5).select("fold").distinct().collect()} == set(range(5))


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(2.0, 1.0), (3.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "x double, c double")
    scaler = fit_scaler(df, ["x", "c"])
    scaled = scaler.scale(df).collect()
    assert [r.x for r in scaled] == pytest.approx([-1.0, 1.0] * 2) and [r.c for r in scaled] == [0.0] * 4
    with pytest.raises(ValueError):
        fit_scaler(df.limit(0), ["x"])


@pytest.mark.parametrize("name, floor", [
    ("random_forest", 0.95), ("gradient_boosting", 0.95), ("ada_boost", 0.95), ("xgboost", 0.95),
    ("logistic_regression", 0.75), ("svc", 0.85), ("knn", 0.85), ("stacked_clf", 0.95),
])
def test_every_classifier_learns(prepared, name, floor):
    best, results = training.train(prepared, [name], params=quick(prepared))
    assert results[0].error is None and best.accuracy >= floor


def test_failing_model_is_reported(spark, prepared):
    class Broken:
        def fit(self, df):
            raise RuntimeError("no")

    results = models.train_all(prepared.parts["train"], prepared.parts["valid"],
                               {"broken": Broken(), "lr": models.PenalizedLogit()})
    assert models.best_of(results).name == "lr"
    table = {r.model: r.error for r in models.results_table(spark, results).collect()}
    assert table == {"broken": "RuntimeError: no", "lr": None}
    with pytest.raises(ValueError):
        models.best_of([r for r in results if r.name == "broken"])


def test_ties_go_to_the_first_name():
    tied = [models.Fitted(n, 0.9, None) for n in ("b", "a", "c")]
    assert models.best_of(tied).name == "a"


def _brute_knn(train, labels, query, k, weights="uniform"):
    """Vote of the k nearest; rows at equal distance share the label in this fixture's ties."""
    out = []
    for q in query:
        d = ((train - q) ** 2).sum(axis=1)
        near = np.argsort(d, kind="stable")[:k]
        if weights == "uniform":
            out.append(float(labels[near].mean() > 0.5))
        else:
            dist = np.sqrt(d[near])
            w = (dist == 0).astype(float) if (dist == 0).any() else 1 / dist
            out.append(float((w * labels[near]).sum() / w.sum() > 0.5))
    return out


@pytest.mark.parametrize("weights", ["uniform", "distance"])
@pytest.mark.parametrize("leaf_rows, chunk_rows, part_rows", [(10_000, 10_000, 10_000), (40, 25, 7)])
def test_neighbours_equal_brute_force(spark, weights, leaf_rows, chunk_rows, part_rows):
    rng = np.random.default_rng(11)
    train = rng.normal(size=(600, 3))
    train[400:] = train[400]  # a third of the rows is one point
    labels = (train[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(float)
    labels[400:] = 1.0
    query = np.vstack([rng.normal(size=(150, 3)), np.repeat(train[400:401], 50, axis=0), [[9.0, 9.0, 9.0]]])
    as_df = lambda x, y: spark.createDataFrame(
        [(i, Vectors.dense(v.tolist()), float(l)) for i, (v, l) in enumerate(zip(x, y))], ["i", "features", "label"])
    model = KnnClassifier(5, weights, leaf_rows, chunk_rows, part_rows).fit(as_df(train, labels))
    if leaf_rows == 40:
        assert model.cells.n_leaves > 5
    got = model.transform(as_df(query, np.zeros(len(query)))).orderBy("i").collect()
    assert [r.prediction for r in got] == _brute_knn(train, labels, query, 5, weights)


def test_cells_cover_every_point():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 2))
    cells = Cells(points, 16)
    leaf = cells.leaf_of(points)
    assert set(leaf) <= set(range(cells.n_leaves)) and cells.n_leaves == 16
    for p, home in zip(points, leaf):
        assert (p >= cells.low[home]).all() and (p <= cells.high[home]).all()
    assert Cells(np.ones((50, 2)), 8).n_leaves == 1


def test_gate(prepared):
    best, _ = training.train(prepared, ["random_forest"], params=quick(prepared))
    report = {r["class"] for r in training.gate(best.model, prepared.parts["test"]).collect()}
    assert "accuracy" in report
    with pytest.raises(ValueError, match="below"):
        training.gate(best.model, prepared.parts["test"], threshold=1.01)
    with pytest.raises(ValueError, match="empty"):
        training.gate(best.model, prepared.parts["test"].limit(0))


def test_register_load_and_score(spark, rows, prepared, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        training.load_registered(spark, root)
    for version, name in ((1, "logistic_regression"), (2, "random_forest")):
        best, _ = training.train(prepared, [name], params=quick(prepared))
        model = training.scoring_model(prepared.scaler, best.model)
        training.register(spark, model, name, root, version, best.accuracy, f"2024-02-0{version} 00:00:00")
    loaded = training.load_registered(spark, root)
    out = training.score(loaded, rows, ["booking_id"])
    expected = training.score(model, rows, ["booking_id"])
    assert out.exceptAll(expected).isEmpty() and out.count() == rows.count()
    assert training.load_registered(spark, root, "logistic_regression").stages[-1].uid != loaded.stages[-1].uid
    request = spark.createDataFrame([(10.0, 100.0, 3, 25, 4)], ",".join(
        f"{f.name} {f.dataType.simpleString()}" for f in training.REQUEST_SCHEMA))
    assert training.score(loaded, training.request_frame(request)).first().booking_status == 0
    training.save_splits(prepared, f"{root}/splits")
    assert spark.read.parquet(f"{root}/splits").count() == rows.count()


@pytest.mark.parametrize("name", ["ada_boost", "svc", "knn", "stacked_clf"])
def test_every_kind_of_model_survives_saving(spark, rows, prepared, tmp_path, name):
    best, _ = training.train(prepared, [name], params=quick(prepared))
    model = training.scoring_model(prepared.scaler, best.model)
    training.register(spark, model, name, str(tmp_path), 1, best.accuracy, "2024-02-01 00:00:00")
    some = rows.filter("booking_id < 300")
    again = training.score(training.load_registered(spark, str(tmp_path)), some, ["booking_id"])
    assert again.exceptAll(training.score(model, some, ["booking_id"])).isEmpty() and again.count() == 300


def test_random_search(prepared):
    preset = models.presets(prepared.scaler.outputs, prepared.key)["logistic_regression"]
    run = lambda: tuning.random_search("logistic_regression", preset, prepared.parts["train"], prepared.key,
                                       prepared.parts["test"], draws=3, folds=2, threshold=0.99)
    found = run()
    assert len(found.trials) == 3 and all(len(t.fold_accuracy) == 2 for t in found.trials)
    assert found.best.mean == max(t.mean for t in found.trials) and found.below_threshold
    assert [t.params for t in run().trials] == [t.params for t in found.trials]
    with pytest.raises(ValueError):
        tuning.random_search("unknown", preset, prepared.parts["train"], prepared.key)


@pytest.mark.parametrize("name, space", [
    ("logistic_regression", None), ("knn", None),
    ("ada_boost", {"rounds": tuning.whole(2, 9), "learning_rate": tuning.uniform(0.2, 1.0)}),
    ("xgboost", {"rounds": tuning.whole(2, 9), "depth": tuning.whole(1, 5)}),
    ("gradient_boosting", {"rounds": tuning.whole(2, 9), "step": tuning.one_of(0.1, 0.4), "depth": tuning.one_of(2)})])
def test_shared_fits_equal_separate_ones(spark, name, space):
    """All draws and folds in the same passes give the accuracies of separate fits."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (900, 3)).astype(float)
    y = ((x[:, 0] > 5) & (x[:, 1] < 8) | (rng.random(900) < 0.1)).astype(float)
    df = spark.createDataFrame([(i, Vectors.dense(r.tolist()), float(l)) for i, (r, l) in enumerate(zip(x, y))], ["booking_id", "features", "label"])
    preset = models.presets(["a", "b", "c"], "booking_id")[name]
    run = lambda share: tuning.random_search(name, preset, df, "booking_id", space=space, draws=3, folds=3, share=share)
    together, alone = run(True), run(False)
    assert [t.params for t in together.trials] == [t.params for t in alone.trials]
    for a, b in zip(together.trials, alone.trials):
        assert a.fold_accuracy == pytest.approx(b.fold_accuracy, abs=1e-9) and a.error is None


def test_paths_of_equal_parameters_are_grown_once(prepared, monkeypatch):
    asked = []
    grow = tuning.grow
    monkeypatch.setattr(tuning, "grow", lambda rows, bins, models: asked.append(models) or grow(rows, bins, models))
    preset = models.presets(prepared.scaler.outputs, prepared.key)["xgboost"]
    tuning.random_search("xgboost", preset, prepared.parts["train"], prepared.key, draws=6, folds=2,
                         space={"rounds": tuning.one_of(2, 5, 7), "depth": tuning.one_of(2)})
    assert len(asked[0]) == 2 and {m.rounds for m, _ in asked[0]} <= {5, 7}


def test_every_space_fits_its_classifier(prepared):
    import random

    options = models.presets(prepared.scaler.outputs, prepared.key)
    for name, space in tuning.SPACES.items():
        assert options[name].make(**{p: draw(random.Random(1)) for p, draw in space.items()}) is not None


def test_unavailable_kernel():
    with pytest.raises(ValueError):
        models.CalibratedSvm(["x"], kernel="sigmoid")


def test_svm_with_polynomial_inputs(prepared):
    svm = models.CalibratedSvm(prepared.scaler.outputs, kernel="poly", max_iter=20)
    model = svm.fit(prepared.parts["train"])
    assert training.accuracy(model.transform(prepared.parts["test"])).first()["accuracy"] > 0.85


@pytest.mark.parametrize("final", ["svc", "knn"])
def test_stacking_with_another_final_classifier(prepared, final):
    options = models.presets(prepared.scaler.outputs, prepared.key)
    base = {n: partial(options[n].make, **QUICK.get(n, {})) for n in ("logistic_regression", "random_forest")}
    stack = options["stacked_clf"].make(base=base, final=final, folds=2)
    model = stack.fit(prepared.parts["train"])
    assert training.accuracy(model.transform(prepared.parts["test"])).first()["accuracy"] > 0.8


def test_a_failing_draw_is_a_row(prepared):
    values = iter([-1.0, 1.0])
    preset = models.presets(prepared.scaler.outputs, prepared.key)["logistic_regression"]
    found = tuning.random_search("logistic_regression", preset, prepared.parts["train"], prepared.key,
                                 space={"C": lambda rng: next(values)}, draws=2, folds=2)
    assert [t.error is None for t in found.trials] == [False, True] and found.best is found.trials[1]
    with pytest.raises(ValueError):
        tuning.random_search("logistic_regression", preset, prepared.parts["train"], prepared.key,
                             space={"C": lambda rng: -1.0}, draws=1, folds=2)


def test_svm_tasks_read_bounded_shares(spark, monkeypatch):
    """The mapped rows are dealt to as many tasks as their number asks for, however few files they came from."""
    rows = [(Vectors.dense([i / 10, 1.0]), i / 10, 1.0, float(i > 200)) for i in range(400)]
    df = spark.createDataFrame(rows, ["features", "a", "b", "label"]).coalesce(1)
    kept = []
    checkpointed = models.checkpointed
    monkeypatch.setattr(models, "checkpointed", lambda rows: kept.append(rows.rdd.getNumPartitions()) or checkpointed(rows))
    monkeypatch.setattr(models, "SVM_TASK_ROWS", 50)
    models.CalibratedSvm(["a", "b"], kernel="rbf", dims=4, max_iter=3).fit(df)
    assert kept == [8]


@pytest.mark.parametrize("dims, k, bounded", [(5, 5, False), (5, 30, True), (2, 3, False)])
def test_a_query_meets_only_the_cells_within_its_radius(monkeypatch, dims, k, bounded):
    rng = np.random.default_rng(3)
    # Few values per feature: many rows at the same distance, which the id decides.
    x = np.unique(rng.integers(0, 60 if dims == 2 else 9, (20_000, dims)) / 4.0, axis=0)
    points = pd.DataFrame({"x": list(x), "label": rng.integers(0, 2, len(x)).astype(float),
                           "n": rng.integers(1, 4, len(x)), "pid": rng.permutation(len(x))})
    queries = np.vstack([x[rng.integers(0, len(x), 200)], rng.normal(1, 1, (200, dims)), np.full((1, dims), 1e3)])
    radius = rng.uniform(0.1, 0.6, len(queries)) if bounded else np.full(len(queries), np.inf)
    met, whole = [], knn._distance

    def counted(q, p):
        met.append(len(q) * len(p))
        return whole(q, p)

    monkeypatch.setattr(knn, "_distance", counted)
    got = knn._nearest(points, queries, radius, k)
    assert sum(met) < len(queries) * len(x) / (3 if dims == 5 else 2)
    pid = points["pid"].to_numpy()
    for q, r, (d, label, n, ids) in zip(queries, radius, got):
        d2 = ((x - q) ** 2).sum(axis=1)
        best = np.lexsort((pid, d2))[:k]
        best = best[d2[best] <= r]
        assert ids == pid[best].tolist() and d == pytest.approx(d2[best].tolist())
        assert (label, n) == (points["label"].to_numpy()[best].tolist(), points["n"].to_numpy()[best].tolist())


def test_few_staged_rows_are_not_spread_and_many_are(spark, monkeypatch):
    """Every core has rows to fit on; the rows are the same, in the files of one stage."""
    df = spark.range(400).select(
        F.col("id").alias("booking_id"), (F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 3 == 0).cast("int").alias("y")
    ).coalesce(1)
    few = training.prepare(df, "y", ["a", "b"])
    monkeypatch.setattr(training, "TASK_ROWS", 50)
    many = training.prepare(df, "y", ["a", "b"])
    assert few.parts["train"].rdd.getNumPartitions() == 1
    assert many.parts["train"].rdd.getNumPartitions() >= 4
    for part in few.parts:
        assert sorted(map(tuple, few.parts[part].collect())) == sorted(map(tuple, many.parts[part].collect()))


def test_prepared_rows_are_written_once(spark, monkeypatch):
    """The scaled columns and the vector are made where they are read, not written beside the rows."""
    def refused(df):
        raise AssertionError("a second copy of the rows")

    monkeypatch.setattr(training, "checkpointed", refused)
    df = spark.range(100).select(F.col("id").alias("booking_id"), (F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("y"))
    data = training.prepare(df, "y", ["a"])
    assert sum(part.count() for part in data.parts.values()) == 100
    assert set(data.parts["train"].columns) >= {"booking_id", "a", "a_scaled", "features", "label"}


def test_out_of_fold_predictions_do_not_wait_for_the_boosted_models(prepared, monkeypatch):
    options = models.presets(prepared.scaler.outputs, prepared.key)
    begun = threading.Event()
    together, only = models.fit_together, models.predict_only
    waited = []

    def late(*args):
        waited.append(begun.wait(60))
        return together(*args)

    def predict(*args):
        begun.set()
        return only(*args)

    monkeypatch.setattr(models, "fit_together", late)
    monkeypatch.setattr(models, "predict_only", predict)
    base = {"ada_boost": partial(options["ada_boost"].make, rounds=2), "logistic_regression": options["logistic_regression"].make}
    model = options["stacked_clf"].make(base=base).fit(prepared.parts["train"])
    assert waited == [True] and list(model.base) == list(base)
