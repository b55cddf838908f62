"""Regression metrics and the evaluation report, from one pass over scored rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.fixed_values import MODEL_BEST


def _metric_rows(scored: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """One row holding an array of (model, rmse, mae), in the order given."""
    aggregates = []
    for i, column in enumerate(predictions.values()):
        error = F.col(label).cast("double") - F.col(column)
        aggregates += [
            F.sqrt(F.avg(error * error)).alias(f"rmse{i}"),
            F.avg(F.abs(error)).alias(f"mae{i}"),
        ]
    structs = [
        F.struct(
            F.lit(model).alias("model"),
            F.col(f"rmse{i}").alias("rmse"),
            F.col(f"mae{i}").alias("mae"),
        )
        for i, model in enumerate(predictions)
    ]
    return scored.agg(*aggregates).select(F.array(*structs).alias("metrics"))


def _best(metrics: Column, models: int) -> Column:
    """Model of the lowest RMSE; of equal ones the one listed last."""
    ranked = F.array(
        *(
            F.struct(
                metrics[i]["rmse"].alias("rmse"), F.lit(-i).alias("rank"), metrics[i]["model"].alias("model")
            )
            for i in range(models)
        )
    )
    return F.array_min(ranked)["model"]


def regression_metrics(scored: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """RMSE and MAE per model; ``predictions`` maps a model name to its column."""
    return _metric_rows(scored, label, predictions).select(F.inline("metrics"))


def best_model(scored: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    return _metric_rows(scored, label, predictions).select(
        _best(F.col("metrics"), len(predictions)).alias("best_model")
    )


def evaluation_report(
    scored: DataFrame, label: str, predictions: Mapping[str, str], run_time: Column | None = None
) -> DataFrame:
    """One row per model plus a last row that names the best; every row carries the
    same time."""
    run_time = F.current_timestamp() if run_time is None else run_time

    def row(model: Column, rmse: Column, mae: Column, best: Column) -> Column:
        return F.struct(
            model.alias("model"),
            rmse.cast("double").alias("rmse"),
            mae.cast("double").alias("mae"),
            best.cast("string").alias("best_model"),
        )

    metrics, none = F.col("metrics"), F.lit(None)
    rows = [
        row(metrics[i]["model"], metrics[i]["rmse"], metrics[i]["mae"], none)
        for i in range(len(predictions))
    ]
    rows.append(row(F.lit(MODEL_BEST), none, none, _best(metrics, len(predictions))))
    return (
        _metric_rows(scored, label, predictions)
        .select(F.inline(F.array(*rows)))
        .withColumn("evaluation_timestamp", run_time)
    )
