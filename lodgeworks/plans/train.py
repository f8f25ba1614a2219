"""Train, choose, tune, gate, register and score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.fields import DEPLOYMENT_THRESHOLD, MODEL_FEATURES, REQUEST_SCHEMA
from lodgeworks.operators.metrics import accuracy, class_report
from lodgeworks.operators.models import Fitted, best_of, presets, results_table, train_all
from lodgeworks.operators.persistence import chain, load_model, save_model
from lodgeworks.operators.split import Scaler, add_split, fit_scaler
from lodgeworks.session import checkpointed, staged
from lodgeworks.sources.files import read_parquet

TASK_ROWS = 10_000  # a fit of fewer rows is not spread over more tasks


@dataclass
class Prepared:
    scaler: Scaler
    parts: dict[str, DataFrame]
    key: str


def prepare(df: DataFrame, label: str, columns: Sequence[str] = MODEL_FEATURES, key: str = "booking_id") -> Prepared:
    """Split by key, fit the scaler on the training part, build the vectors."""
    # The scaler and the vectors both read these rows.
    rows = staged(add_split(
        df.select(key, *columns, F.col(label).cast("double").alias("label")), key
    ), "prepared")
    scaler = fit_scaler(rows.filter("split = 'train'"), columns)
    # Many fits read these rows, each the columns it needs; scaling them again costs less than a second, wider copy.
    data = PipelineModel(scaler.stages()).transform(_spread(rows))
    return Prepared(scaler, {s: data.filter(F.col("split") == s) for s in ("train", "valid", "test")}, key)


def _spread(rows: DataFrame) -> DataFrame:
    """Staged rows in more tasks, where they are too few to keep the cores busy."""
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS)
    return staged(rows.repartition(tasks), "prepared") if tasks >= 2 * rows.rdd.getNumPartitions() else rows


def train(
    prepared: Prepared, names: Sequence[str] | None = None, select_on: str = "valid", threads: int = 4,
    params: dict[str, dict[str, Any]] | None = None,
) -> tuple[Fitted, list[Fitted]]:
    """Fit the named classifiers (all by default) and choose on ``select_on``.

    ``params`` gives parameters per classifier that replace those of its preset.
    """
    options, params = presets(prepared.scaler.outputs, prepared.key), params or {}
    chosen = {n: options[n].make(**params.get(n, {})) for n in (names or options)}
    # Base models of the stack at their presets are the models fitted here.
    shared = [n for n in chosen if not params.get(n)] if "base" not in params.get("stacked_clf", {}) else []
    results = train_all(prepared.parts["train"], prepared.parts[select_on], chosen, threads, shared)
    return best_of(results), results


def model_table(spark: SparkSession, results: Sequence[Fitted]) -> DataFrame:
    return results_table(spark, results)


def gate(model: Any, test: DataFrame, threshold: float = DEPLOYMENT_THRESHOLD) -> DataFrame:
    """The class report of a model that passes; raises on an empty test set or low accuracy."""
    scored = checkpointed(model.transform(test).select("label", "prediction"))
    score = accuracy(scored).first()["accuracy"]
    if score is None:
        raise ValueError("the test data is empty")
    if score < threshold:
        raise ValueError(f"accuracy {score:.4f} is below {threshold}")
    return class_report(scored)


def scoring_model(scaler: Scaler, model: Any) -> Any:
    """Scaler and classifier as one model that takes raw request columns."""
    return chain(scaler.stages(), model)


def register(
    spark: SparkSession, model: Any, name: str, root: str, version: int, score: float, run_ts: str
) -> str:
    """Save the model under its version and add a row to the ``models`` table."""
    path = f"{root}/{name}/version={version}"
    save_model(spark, model, path)
    row = spark.createDataFrame(
        [(name, version, path, float(score))], "model string, version int, path string, accuracy double"
    )
    row.withColumn("registered", F.lit(run_ts).cast("timestamp_ntz")).write.mode("append").parquet(f"{root}/models")
    return path


def load_registered(spark: SparkSession, root: str, name: str | None = None) -> Any:
    """The newest registered model (of ``name``, or of any name)."""
    models = read_parquet(spark, f"{root}/models")
    if name is not None:
        models = models.filter(F.col("model") == name)
    newest = models.orderBy(F.desc("registered"), F.desc("accuracy"), F.desc("version")).first()
    if newest is None:
        raise FileNotFoundError(f"no registered model under {root}")
    return load_model(spark, newest["path"])


def save_splits(prepared: Prepared, path: str) -> None:
    """All parts in one table, one directory per part."""
    union = None
    for part in prepared.parts.values():
        columns = [c for c in part.columns if c != "features"]
        union = part.select(*columns) if union is None else union.unionByName(part.select(*columns))
    union.write.mode("overwrite").partitionBy("split").parquet(path)


def request_frame(df: DataFrame) -> DataFrame:
    """The five request columns in order, with the request types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA])


def score(model: Any, requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Requests with ``booking_status`` as predicted; batch or stream."""
    scored = model.transform(requests)
    columns = [*keep, *REQUEST_SCHEMA.fieldNames()]
    return scored.select(*columns, F.col("prediction").cast("long").alias("booking_status"))
