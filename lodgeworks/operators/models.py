"""The classifiers: Spark ML presets, boosted trees, a random forest, a calibrated SVM and stacking.

Every classifier has ``fit(df) -> model`` and every model ``transform(df)``; ``df`` carries a vector
``features``, the scaled input columns and a ``label`` of 0.0 / 1.0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.operators.boosting import Boost, BoostedTrees, fit_together
from lodgeworks.operators.extratrees import extra_trees_importance
from lodgeworks.operators.forest import Forest, RandomForest
from lodgeworks.operators.knn import KnnClassifier
from lodgeworks.operators.metrics import accuracy
from lodgeworks.operators.split import add_fold
from lodgeworks.session import checkpointed

MAX_DEPTH = 30  # the deepest tree of a forest that Spark ML accepts
FOREST_ROWS = 1 << 20  # training rows up to which the forest is Spark ML's
SVM_TASK_ROWS = 200_000  # mapped rows are long: a task of the SVM reads at most about so many


class CalibratedSvm:
    """Linear SVM with a logistic fit on its margin; ``rbf`` and ``poly`` map the inputs first.

    Random Fourier features approximate the ``rbf`` kernel of width ``gamma`` (default 1 / number of
    inputs, which is what scaled inputs give); ``poly`` expands to all products of up to ``degree``
    inputs. The training stays linear in the rows.
    """

    def __init__(self, inputs: Sequence[str], C: float = 1.0, kernel: str = "rbf", gamma: float | None = None,
                 dims: int = 128, max_iter: int = 100, seed: int = 42, degree: int = 3) -> None:
        if kernel not in ("rbf", "linear", "poly"):
            raise ValueError(f"kernel {kernel!r} is not available")
        self.inputs, self.C, self.kernel, self.gamma = list(inputs), C, kernel, gamma
        self.dims, self.max_iter, self.seed, self.degree = dims, max_iter, seed, degree

    def _mapping(self) -> list:
        if self.kernel == "linear":
            return []
        if self.kernel == "poly":
            return [PolynomialExpansion(degree=self.degree, inputCol="features", outputCol="_mapped")]
        rng = np.random.default_rng(self.seed)
        gamma = self.gamma or 1.0 / len(self.inputs)
        weights = rng.normal(0.0, math.sqrt(2 * gamma), (self.dims, len(self.inputs)))
        shifts = rng.uniform(0.0, 2 * math.pi, self.dims)
        size = math.sqrt(2.0 / self.dims)
        names = [f"_f{i}" for i in range(self.dims)]
        parts = []
        for name, row, shift in zip(names, weights.tolist(), shifts.tolist()):
            dot = " + ".join(f"{w!r}D * `{c}`" for w, c in zip(row, self.inputs))
            parts.append(f"{size!r}D * cos({dot} + {shift!r}D) AS {name}")
        return [
            SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol="_mapped"),
        ]

    def fit(self, df: DataFrame) -> PipelineModel:
        stages = self._mapping()
        tasks = -(-df.count() // SVM_TASK_ROWS)
        df = df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df
        mapped = PipelineModel(stages).transform(df) if stages else df
        vector = "_mapped" if stages else "features"
        kept = checkpointed(mapped.select(vector, "label"))
        svm = LinearSVC(
            featuresCol=vector, maxIter=self.max_iter, regParam=1.0 / (self.C * kept.count()),
            standardization=False, rawPredictionCol="_margin",
        ).fit(kept)
        # The probability comes from the margin; the class stays the side of the margin.
        platt = LogisticRegression(
            featuresCol="_margin", predictionCol="_platt", rawPredictionCol="_platt_raw",
            probabilityCol="svm_probability",
        ).fit(svm.transform(kept).select("_margin", "label"))
        return PipelineModel([*stages, svm, platt])


class SizedForest:
    """Spark ML's forest up to ``FOREST_ROWS`` training rows; beyond, where its passes and nodes outgrow the input, the one over cells.

    Both draw rows and features alike, but not the same ones, and their cuts differ; so do single predictions.
    """

    def __init__(self, trees: int, depth: int, seed: int, min_leaf: int = 1, impurity: str = "gini") -> None:
        self.few = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=min_leaf, impurity=impurity, featureSubsetStrategy="sqrt",
        )
        self.many = RandomForest(Forest(trees, depth, seed, min_leaf, impurity))

    def fit(self, df: DataFrame):
        return (self.few if df.count() <= FOREST_ROWS else self.many).fit(df)


class PenalizedLogit:
    """Logistic regression with the penalty given as ``C``."""

    def __init__(self, C: float = 1.0, max_iter: int = 1_000) -> None:
        if not C > 0:
            raise ValueError("C must be positive")
        self.C, self.max_iter = C, max_iter

    def fit(self, df: DataFrame):
        return LogisticRegression(
            maxIter=self.max_iter, regParam=1.0 / (self.C * df.count()), standardization=False
        ).fit(df)


class Stacking:
    """Out-of-fold predictions of the base models join the inputs of a final classifier."""

    def __init__(self, base: dict[str, Callable[[], Any]], inputs: Sequence[str], key: str,
                 folds: int = 2, final: Callable[[], Any] = PenalizedLogit, threads: int = 8) -> None:
        self.base, self.inputs, self.key = dict(base), list(inputs), key
        self.folds, self.final, self.threads = folds, final, threads

    def fit(self, df: DataFrame) -> StackedModel:
        """Boosted base models grow together, for all folds and for all rows, in the same passes.

        Most fits are many short jobs, so they run beside each other; out-of-fold predictions begin as soon as a model's fits are done.
        """
        data = checkpointed(add_fold(df, self.key, self.folds))
        made = {n: make() for n, make in self.base.items()}
        fits = [(n, f) for n in made for f in [*range(self.folds), None]]
        boosted = [(n, f) for n, f in fits if isinstance(made[n], BoostedTrees)]

        def one(at: tuple) -> Any:
            name, f = at
            return made[name].fit(data if f is None else data.filter(F.col("fold") != f))

        models: dict[tuple, Any] = {}

        def out_of_fold(name: str) -> DataFrame:
            parts = [predict_only(models[name, f], data.filter(F.col("fold") == f), [self.key], f"b_{name}") for f in range(self.folds)]
            return checkpointed(reduce(DataFrame.unionByName, parts))

        with ThreadPoolExecutor(self.threads) as pool:
            together = pool.submit(fit_together, [(made[n], f) for n, f in boosted], data, "fold") if boosted else None
            others = {at: pool.submit(one, at) for at in fits if at not in boosted}
            guesses = {}
            for name, f in others:
                models[name, f] = others[name, f].result()
                if f is None:  # the last fit of a model
                    guesses[name] = pool.submit(out_of_fold, name)
            models.update(zip(boosted, together.result() if together else []))
            if failed := next((m for m in models.values() if isinstance(m, Exception)), None):
                raise failed
            guesses.update({n: pool.submit(out_of_fold, n) for n in made if n not in guesses})
        whole = {n: models[n, None] for n in made}
        stacked = data
        for n in made:
            stacked = stacked.join(guesses[n].result(), self.key)
        stacked = _stack_vector(stacked, self.inputs, self.base)
        return StackedModel({n: whole[n] for n in self.base}, self.inputs, self.key, self.final().fit(stacked))


@dataclass
class StackedModel:
    base: dict[str, Any]
    inputs: list[str]
    key: str
    final: Any

    def transform(self, df: DataFrame) -> DataFrame:
        stacked = df
        for name, model in self.base.items():
            stacked = _with_prediction(model, stacked, f"b_{name}")
        out = self.final.transform(_stack_vector(stacked, self.inputs, self.base))
        return out.select(*df.columns, "prediction")


def _stack_vector(df: DataFrame, inputs: Sequence[str], base) -> DataFrame:
    names = [*inputs, *[f"b_{n}" for n in base]]
    return VectorAssembler(inputCols=names, outputCol="features").transform(df.drop("features"))


def _with_prediction(model, df: DataFrame, name: str) -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", name).select(*df.columns, name)


def predict_only(model, df: DataFrame, keep: Sequence[str], name: str = "prediction") -> DataFrame:
    return model.transform(df).select(*keep, F.col("prediction").alias(name))


@dataclass(frozen=True)
class Preset:
    """How to build a classifier from named parameters, and the parameters it has by default."""

    build: Callable[..., Any]
    defaults: dict[str, Any]

    def make(self, **params: Any):
        return self.build(**{**self.defaults, **params})


def _boosted(key: str, **params: Any) -> BoostedTrees:
    return BoostedTrees(Boost(**params), key)


def _stumps(key: str, rounds: int, learning_rate: float, seed: int) -> BoostedTrees:
    return BoostedTrees(Boost("stumps", rounds=rounds, depth=1, step=learning_rate, seed=seed), key)


def presets(inputs: Sequence[str], key: str, seed: int = 42) -> dict[str, Preset]:
    """The eight classifiers by name. The forest's depth is bounded, as Spark grows whole levels in memory."""
    options = {
        "random_forest": Preset(SizedForest, {"trees": 100, "depth": 15, "seed": seed}),
        "gradient_boosting": Preset(_boosted, {"kind": "gradient", "rounds": 100, "depth": 3, "step": 0.1, "seed": seed, "key": key}),
        "ada_boost": Preset(_stumps, {"rounds": 50, "learning_rate": 1.0, "seed": seed, "key": key}),
        "xgboost": Preset(_boosted, {"kind": "second_order", "rounds": 100, "depth": 6, "step": 0.3, "seed": seed, "key": key}),
        "logistic_regression": Preset(PenalizedLogit, {"C": 1.0, "max_iter": 1_000}),
        "svc": Preset(CalibratedSvm, {"inputs": inputs, "C": 1.0, "kernel": "rbf", "seed": seed,
                                      "dims": 128, "max_iter": 100}),
        "knn": Preset(KnnClassifier, {"k": 5, "weights": "uniform"}),
    }
    makers = {n: p.make for n, p in options.items()}

    # The final classifier by its name; it sees the inputs and the predictions of the base models.
    def stacking(base: dict, inputs: Sequence[str], final: str = "logistic_regression", **params: Any) -> Stacking:
        own = {"inputs": [*inputs, *[f"b_{n}" for n in base]]} if final == "svc" else {}
        return Stacking(base, inputs, final=partial(options[final].make, **own), **params)

    return {
        **options,
        "stacked_clf": Preset(stacking, {"base": makers, "inputs": inputs, "key": key, "folds": 2}),
    }


@dataclass
class Fitted:
    name: str
    accuracy: float | None
    error: str | None
    model: Any = None


def train_all(
    train: DataFrame, test: DataFrame, classifiers: dict[str, Any], threads: int = 4, shared: Sequence[str] = (),
) -> list[Fitted]:
    """Fit every classifier from driver threads; one that fails is reported, not fatal.

    The data stays in Spark: the threads only submit jobs that share the executors. Boosted models grow together. A stack
    is fitted first, and its base models named in ``shared``, which must be the classifiers of those names, are not fitted again.
    """
    def judged(name: str, fit: Callable[[], Any]) -> Fitted:
        try:
            model = fit()
            if isinstance(model, Exception):
                raise model
            score = accuracy(model.transform(test)).first()["accuracy"]
            return Fitted(name, score, None, model)
        except Exception as error:  # noqa: BLE001 - any failure of one model is a result row
            return Fitted(name, None, f"{type(error).__name__}: {error}")

    found: dict[str, Fitted] = {}
    known: dict[str, Any] = {}
    for n, c in classifiers.items():
        if isinstance(c, Stacking):
            found[n] = judged(n, lambda c=c: c.fit(train))
            if found[n].error is None:
                known.update({b: m for b, m in found[n].model.base.items() if b in shared})
    rest = [n for n in classifiers if n not in found]
    boosted = [n for n in rest if n not in known and isinstance(classifiers[n], BoostedTrees)]
    with ThreadPoolExecutor(threads) as pool:
        together = pool.submit(fit_together, [(classifiers[n], None) for n in boosted], train) if boosted else None

        def fit(name: str) -> Any:
            return known[name] if name in known else classifiers[name].fit(train)

        single = [n for n in rest if n not in boosted]
        found.update(zip(single, pool.map(lambda n: judged(n, lambda: fit(n)), single)))
        for i, n in enumerate(boosted):
            found[n] = judged(n, lambda i=i: together.result()[i])
    return [found[n] for n in classifiers]


def results_table(spark, results: Sequence[Fitted]) -> DataFrame:
    return spark.createDataFrame(
        [(r.name, r.accuracy, r.error) for r in results], "model string, accuracy double, error string"
    )


def best_of(results: Sequence[Fitted]) -> Fitted:
    """Highest accuracy, ties by name; raises when every model failed."""
    good = [r for r in results if r.accuracy is not None]
    if not good:
        raise ValueError(f"no model could be trained: {[(r.name, r.error) for r in results]}")
    return min(good, key=lambda r: (-r.accuracy, r.name))


def feature_importance(
    df: DataFrame, columns: Sequence[str], label: str = "label", trees: int = 100, seed: int = 42, **options: Any,
) -> DataFrame:
    """``(feature, importance)`` from extremely randomised trees on all rows; sums to 1. ``options`` as for ``extra_trees_importance``."""
    return extra_trees_importance(df, columns, label, trees, seed, **options)


def important_features(importance: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Features strictly above the threshold."""
    if isinstance(threshold, bool) or not isinstance(threshold, (int, float)):
        raise ValueError("the threshold must be a number")
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold must lie between 0 and 1")
    return importance.filter(F.col("importance") > threshold)


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
