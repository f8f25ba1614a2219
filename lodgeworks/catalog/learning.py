"""Model queries. The label follows from the features, because the status in the generated tables
is independent of them and no model could pass the gate on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.features import _TABLE_SQL, feature_rows
from lodgeworks.catalog.registry import over_bookings, over_cleaned, query
from lodgeworks.fields import CATEGORICAL
from lodgeworks.operators import features, models, tuning
from lodgeworks.operators.models import presets
from lodgeworks.plans import train as training
from lodgeworks.session import fresh_path, staged
from lodgeworks.sources.bookings import bookings

RUN_TS = "2024-02-01 00:00:00"


def labelled(spark, sf):
    rows = feature_rows(spark, sf)
    late_and_dear = (F.col("lead_time") > 180) & (F.col("avg_price_per_room") > 150)
    return rows.withColumn("likely", late_and_dear.cast("int"))


def prepared(spark, sf):
    return training.prepare(labelled(spark, sf), "likely")


_PREPARED: dict = {}
_FITTED: dict = {}


def _shared(spark, sf):
    """The prepared rows of a table; several queries of one session read the same checkpoint."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _PREPARED:
        _PREPARED[at] = prepared(spark, sf)
    return _PREPARED[at]


def _fitted(spark, sf, names=None):
    """The named classifiers (all eight by default) at their presets, each trained once per session and table."""
    data = _shared(spark, sf)
    names = list(names or presets(data.scaler.outputs, data.key))
    at = (spark.sparkContext.applicationId, sf)
    missing = [n for n in names if (*at, n) not in _FITTED]
    if missing:
        for result in training.train(data, missing)[1]:
            _FITTED[*at, result.name] = result
    return data, [_FITTED[*at, n] for n in names]


def forget() -> None:
    """Drop the shared rows and models, so that the next query fits its own."""
    _PREPARED.clear()
    _FITTED.clear()


def _fit_query(query_name: str, model_name: str) -> None:
    @query(query_name)
    def fit(spark, sf):
        data, (best,) = _fitted(spark, sf, [model_name])
        held = data.parts["valid"].unionByName(data.parts["test"])
        return best.model.transform(held).select("booking_id", "split", F.col("label").cast("long").alias("label"),
                                                 F.col("prediction").cast("long").alias("prediction"))


_fit_query("m4_random_forest", "random_forest")
_fit_query("m5_gradient_boosting", "gradient_boosting")
_fit_query("m6_second_boosting_preset", "xgboost")
_fit_query("m7_logistic_regression", "logistic_regression")
_fit_query("m8_ada_boost", "ada_boost")
_fit_query("m9_support_vectors", "svc")
_fit_query("m10_nearest_neighbours", "knn")
_fit_query("m11_stacking", "stacked_clf")


@query("m12_train_and_rank")
def train_and_rank(spark, sf):
    return models.results_table(spark, _fitted(spark, sf)[1])


@query("t6_best_model")
def best_model(spark, sf):
    best = models.best_of(_fitted(spark, sf)[1])
    return spark.createDataFrame([(best.name, best.accuracy)], "model string, accuracy double")


@query("m6_gain_importance")
def gain_importance(spark, sf):
    """The share of each input in the gain of all splits of the second-order trees."""
    data, (best,) = _fitted(spark, sf, ["xgboost"])
    return spark.createDataFrame(list(zip(data.scaler.columns, best.model.importance())), "feature string, importance double")


def _search_query(query_name: str, model_name: str) -> None:
    @query(query_name)
    def search(spark, sf):
        """Ten draws with five folds."""
        data = _shared(spark, sf)
        preset = presets(data.scaler.outputs, data.key)[model_name]
        found = tuning.random_search(model_name, preset, data.parts["train"], data.key, data.parts["test"], threads=4)
        return spark.createDataFrame(
            [(i, repr(t.params), t.mean, t is found.best, t.error) for i, t in enumerate(found.trials)],
            "draw int, params string, accuracy double, best boolean, error string",
        )


_search_query("m13_random_search", "logistic_regression")
_search_query("m13_search_ada_boost", "ada_boost")
_search_query("m13_search_nearest_neighbours", "knn")


@query("m14_deployment_gate")
def deployment_gate(spark, sf):
    data, (best,) = _fitted(spark, sf, ["random_forest"])
    return training.gate(best.model, data.parts["test"])


def _scored(spark, sf):
    data, (best,) = _fitted(spark, sf, ["random_forest"])
    root = fresh_path(spark, "registry")
    model = training.scoring_model(data.scaler, best.model)
    training.register(spark, model, best.name, root, 1, best.accuracy, RUN_TS)
    return model, training.load_registered(spark, root)


_ALL_KEPT = over_cleaned(f"SELECT COUNT(*) AS n, COUNT(*) AS n_same FROM ({_TABLE_SQL})")


@query("s11_model_save_and_load", _ALL_KEPT)
def save_and_load(spark, sf):
    model, loaded = _scored(spark, sf)
    rows = staged(labelled(spark, sf), "labelled")
    kept = training.score(model, rows, ["booking_id"]).select("booking_id", F.col("booking_status").alias("a"))
    again = training.score(loaded, rows, ["booking_id"]).select("booking_id", F.col("booking_status").alias("b"))
    return kept.join(again, "booking_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_same")
    )


@query("m16_predict")
def predict(spark, sf):
    _, model = _scored(spark, sf)
    return training.score(model, training.request_frame(labelled(spark, sf)))


@query("m15_scaler_and_model")
def scaler_and_model(spark, sf):
    data, (best,) = _fitted(spark, sf, ["logistic_regression"])
    model = training.scoring_model(data.scaler, best.model)
    return training.score(model, labelled(spark, sf), ["booking_id"]).groupBy("booking_status").agg(
        F.count(F.lit(1)).alias("n")
    )


# Every label of the data with each booking; a missing label is none of them.
_ONE_HOT_SQL = " UNION ALL ".join(
    f"""SELECT k, booking_status, '{c}=' || v AS feature, COALESCE(({c} = v)::INT, 0) AS hit
    FROM bookings CROSS JOIN (SELECT DISTINCT {c} AS v FROM bookings WHERE {c} IS NOT NULL)"""
    for c in CATEGORICAL)


def _one_hot(spark, sf, *more):
    df = bookings(spark, sf, [*CATEGORICAL, *more], key=True)
    labels = features.fit_label_codes(df, CATEGORICAL).known()
    hot = features.one_hot(df, labels)
    return hot, [f"{c}={v}" for c, known in labels.items() for v in known]


@query("m17_one_hot", over_bookings(f"SELECT k, feature, hit FROM ({_ONE_HOT_SQL})"))
def one_hot(spark, sf):
    """All category columns; the labels are those of the data. One row per booking and label."""
    hot, names = _one_hot(spark, sf)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").alias("hit")) for n in names])
    return hot.select("k", F.explode(cells).alias("c")).select("k", "c.feature", "c.hit")


_K_BEST = 5


@query(
    "m17_k_best",
    over_bookings(
        f"""SELECT feature, ROUND(SUM((n - e) ** 2 / e), 6)::DOUBLE AS statistic FROM (
          SELECT feature, SUM(hit)::DOUBLE AS n, SUM(SUM(hit)) OVER (PARTITION BY feature)::DOUBLE
            * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY feature) AS e
          FROM ({_ONE_HOT_SQL}) WHERE booking_status IS NOT NULL
          GROUP BY feature, booking_status)
        GROUP BY feature ORDER BY statistic DESC, feature LIMIT {_K_BEST}"""),
)
def k_best(spark, sf):
    """The one-hot columns that depend most on the target."""
    hot, names = _one_hot(spark, sf, "booking_status")
    best = features.k_best(features.chi2_scores(hot, names, "booking_status"), _K_BEST)
    return best.select("feature", F.round("statistic", 6).alias("statistic"))


@query(
    "m17_chi_square",
    over_bookings(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", ROUND(SUM((n - r * l / t) ** 2 / (r * l / t)), 6)::DOUBLE AS statistic,
        ((COUNT(DISTINCT v) - 1) * (COUNT(DISTINCT b) - 1))::BIGINT AS degrees
        FROM (SELECT v, b, COUNT(x.{c})::DOUBLE AS n, ANY_VALUE(r)::DOUBLE AS r, ANY_VALUE(l)::DOUBLE AS l,
            (SELECT COUNT({c}) FROM bookings)::DOUBLE AS t
          FROM (SELECT {c} AS v, COUNT(*) AS r FROM bookings WHERE {c} IS NOT NULL GROUP BY 1)
          CROSS JOIN (SELECT booking_status AS b, COUNT({c}) AS l FROM bookings GROUP BY 1)
          LEFT JOIN bookings x ON x.{c} = v AND x.booking_status = b GROUP BY v, b)"""
        for c in CATEGORICAL)),
)
def chi_square(spark, sf):
    df = bookings(spark, sf, [*CATEGORICAL, "booking_status"])
    found = features.chi_square(df, CATEGORICAL, "booking_status")
    return found.withColumn("statistic", F.round("statistic", 6))
