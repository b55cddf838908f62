"""Fitted models on shared storage: scoring needs no fit, and no session that has fitted."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from rainlane.schemas import DOUBLE, TEXT, TIME, struct
from rainlane.settings import Layout

#: What a stored model was chosen from and how it did.
CARD = struct(model=TEXT, path=TEXT, grid=TEXT, chosen=TEXT, rmse=DOUBLE, mae=DOUBLE, fitted_at=TIME)


def chosen_params(model: PipelineModel, grid) -> dict:
    """The values that the fitted model has for the parameters of the grid."""
    last = model.stages[-1]
    return {name: len(last.trees) if name in ("numTrees", "maxIter") else last.getOrDefault(name) for name in grid}


def save_models(
    layout: Layout, models: dict[str, tuple[PipelineModel, dict]], report: DataFrame, fitted_at: datetime
) -> None:
    """Write ``models`` (name -> fitted pipeline and its grid) and a card of each, with the
    metrics that ``report`` has for it."""
    spark = report.sparkSession
    metrics = {r.model: (r.rmse, r.mae) for r in report.collect()}
    cards = []
    for name, (model, grid) in models.items():
        path = layout.model(name)
        model.write().overwrite().save(path)
        searched = json.dumps({k: list(v) for k, v in grid.items()})
        cards.append((name, path, searched, json.dumps(chosen_params(model, grid)), *metrics[name], fitted_at))
    spark.createDataFrame(cards, CARD).coalesce(1).write.mode("overwrite").parquet(layout.model_cards)


def load_models(spark: SparkSession, layout: Layout) -> dict[str, PipelineModel]:
    """The models that were saved by the run that ``layout`` is of."""
    cards = spark.read.schema(CARD).parquet(layout.model_cards)
    return {r.model: PipelineModel.load(r.path) for r in cards.collect()}
