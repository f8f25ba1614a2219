"""Saving and loading of models, including those that are not made of Spark ML stages alone."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from lodgeworks.operators.boosting import BoostedModel
from lodgeworks.operators.forest import ForestModel
from lodgeworks.operators.knn import Cells, KnnClassifier, KnnModel
from lodgeworks.operators.models import StackedModel


class ScoringModel:
    """A scaler in front of a model that Spark ML cannot hold in one pipeline."""

    def __init__(self, scaler: PipelineModel, model: Any) -> None:
        self.scaler, self.model = scaler, model

    @property
    def stages(self) -> list:
        return [*self.scaler.stages, self.model]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.scaler.transform(df))


def is_native(model: Any) -> bool:
    return hasattr(model, "write")


def chain(scaler_stages: list, model: Any) -> Any:
    """Scaler and model as one: a pipeline where Spark ML can hold it."""
    if is_native(model):
        return PipelineModel([*scaler_stages, model])
    return ScoringModel(PipelineModel(scaler_stages), model)


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    row = spark.createDataFrame([(json.dumps(meta),)], "meta string")
    row.write.mode("overwrite").parquet(f"{path}/meta")


def save_model(spark: SparkSession, model: Any, path: str) -> None:
    """Write the model below ``path``; every part is a Spark ML save or a table."""
    if isinstance(model, ScoringModel):
        save_model(spark, model.scaler, f"{path}/scaler")
        save_model(spark, model.model, f"{path}/model")
        meta = {"kind": "scoring"}
    elif isinstance(model, StackedModel):
        for name, base in model.base.items():
            save_model(spark, base, f"{path}/base/{name}")
        save_model(spark, model.final, f"{path}/final")
        meta = {"kind": "stacked", "base": list(model.base), "inputs": model.inputs, "key": model.key}
    elif isinstance(model, KnnModel):
        model.rows.write.mode("overwrite").parquet(f"{path}/points")
        s = model.settings
        meta = {
            "kind": "knn", "k": s.k, "weights": s.weights, "leaf_rows": s.leaf_rows,
            "chunk_rows": s.chunk_rows, "part_rows": s.part_rows, "cells": model.cells.to_dict(),
        }
    elif isinstance(model, BoostedModel):
        meta = {"kind": "boosted", **model.save(spark, path)}
    elif isinstance(model, ForestModel):
        meta = {"kind": "forest", **model.save(spark, path)}
    elif is_native(model):
        whole = model if isinstance(model, PipelineModel) else PipelineModel([model])
        whole.write().overwrite().save(f"{path}/stages")
        meta = {"kind": "stages"}
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    _write_meta(spark, path, meta)


def load_model(spark: SparkSession, path: str) -> Any:
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    kind = meta["kind"]
    if kind == "stages":
        return PipelineModel.load(f"{path}/stages")
    if kind == "scoring":
        return ScoringModel(load_model(spark, f"{path}/scaler"), load_model(spark, f"{path}/model"))
    if kind == "stacked":
        base = {n: load_model(spark, f"{path}/base/{n}") for n in meta["base"]}
        return StackedModel(base, meta["inputs"], meta["key"], load_model(spark, f"{path}/final"))
    if kind == "boosted":
        return BoostedModel.load(spark, path, meta)
    if kind == "forest":
        return ForestModel.load(spark, path, meta)
    settings = KnnClassifier(meta["k"], meta["weights"], meta["leaf_rows"], meta["chunk_rows"], meta["part_rows"])
    return KnnModel(settings, spark.read.parquet(f"{path}/points"), Cells.from_dict(meta["cells"]))
