"""Trusted -> fitted models, evaluation report, scored scenario."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.fixed_values import MODEL_GBT, MODEL_RF
from rainlane.learning import store, trees
from rainlane.operators.metrics import evaluation_report
from rainlane.operators.scenario import default_scenario
from rainlane.operators.splitting import hashed_in_training
from rainlane.schemas import MODEL_EVALUATION, PREDICTIONS, SCENARIO
from rainlane.settings import Layout, Settings
from rainlane.sinks.tables import conformed, overwrite_table
from rainlane.sources.tables import read_table


@dataclass(frozen=True)
class Fitted:
    rf: PipelineModel
    gbt: PipelineModel
    report: DataFrame


def holdout_scores(rf: PipelineModel, gbt: PipelineModel, holdout: DataFrame) -> DataFrame:
    """Both predictions side by side, so the metrics need one pass."""
    by_rf = rf.transform(holdout).select(
        *holdout.columns, F.col("prediction").alias("rf_prediction")
    )
    return gbt.transform(by_rf).select(
        trees.LABEL, "rf_prediction", F.col("prediction").alias("gbt_prediction")
    )


def fit_and_report(
    train: DataFrame,
    holdout: DataFrame,
    settings: Settings,
    run_time: datetime | None = None,
    fold_column: str = "",
) -> Fitted:
    """Search both grids on ``train`` and report on ``holdout``."""
    trees.prepare_checkpoints(train.sparkSession)
    grids = settings.grids

    def best(regressor, grid) -> PipelineModel:
        return trees.cross_validated(regressor, grid, settings, fold_column).fit(train).bestModel

    rf, gbt = best(trees.forest(settings), grids.rf), best(trees.boosted(settings), grids.gbt)
    report = evaluation_report(
        holdout_scores(rf, gbt, holdout),
        trees.LABEL,
        {MODEL_RF: "rf_prediction", MODEL_GBT: "gbt_prediction"},
        None if run_time is None else F.lit(run_time),
    )
    return Fitted(rf, gbt, report)


def model_rows(trusted: DataFrame, settings: Settings) -> DataFrame:
    """Labelled rows with their part and fold, written once for all fits.

    Part and fold follow from the content of a row, so equal rows are in one part, and
    neither the partitioning nor a lost task changes them. Rows that lack the label or a
    feature raise, with their number, or are left out, by ``settings.missing``.
    ``settings.fit_rows`` bounds the training part by a share of it that the content of a
    row decides too.
    """
    wanted = [settings.label, *settings.features]
    complete = reduce(Column.__and__, (F.col(c).isNotNull() for c in wanted))
    lacking = trusted.agg(F.count_if(~complete)).first()[0]
    if lacking and settings.missing != "leave_out":
        raise ValueError(f"{lacking} rows lack the label or a feature; missing='leave_out' drops them")
    content = F.xxhash64(*trusted.columns)
    rows = trees.labelled(
        trusted.where(complete).withColumns(
            {
                "in_training": hashed_in_training(content, settings.train_share, settings.seed),
                "fold": F.pmod(F.xxhash64(content, F.lit(settings.seed + 1)), F.lit(settings.grids.folds)).cast("int"),
                "draw": F.pmod(F.xxhash64(content, F.lit(settings.seed + 2)), F.lit(1_000_000)),
            }
        ),
        settings,
        "in_training",
        "fold",
        "draw",
    )
    rows = trees.fit_table(rows, settings, "model-rows")
    if settings.fit_rows is not None:
        n = rows.where("in_training").count()
        share = int(1_000_000 * min(1.0, settings.fit_rows / max(n, 1)))
        rows = rows.where(~F.col("in_training") | (F.col("draw") < share))
    return rows.drop("draw")


def train_eval(trusted: DataFrame, settings: Settings, run_time: datetime | None = None) -> Fitted:
    """The same on the two parts of a stable split, with folds that are as stable."""
    rows = model_rows(trusted, settings)
    train, holdout = rows.where("in_training"), rows.where("not in_training")
    return fit_and_report(train, holdout, settings, run_time, fold_column="fold")


def write_forecast(
    trusted: DataFrame, layout: Layout, settings: Settings, run_time: datetime | None = None
) -> Fitted:
    """Fit, report, store the models, and score with them."""
    fitted = train_eval(trusted, settings, run_time)
    overwrite_table(conformed(fitted.report, MODEL_EVALUATION), layout.model_evaluation)
    report = read_table(trusted.sparkSession, layout.model_evaluation, MODEL_EVALUATION)
    models = {MODEL_RF: (fitted.rf, settings.grids.rf), MODEL_GBT: (fitted.gbt, settings.grids.gbt)}
    store.save_models(layout, models, report, run_time or datetime.now(timezone.utc))
    write_scores(trusted, fitted.rf, fitted.gbt, layout, settings)
    return fitted


def write_scores(
    trusted: DataFrame, rf: PipelineModel, gbt: PipelineModel, layout: Layout, settings: Settings
) -> None:
    """The scenario and its scores, and the trusted days that have all features with both scores."""
    spark = trusted.sparkSession
    overwrite_table(conformed(default_scenario(spark, settings.seed), SCENARIO), layout.scenario)
    rows = read_table(spark, layout.scenario, SCENARIO)
    overwrite_table(conformed(trees.score(rf, rows), PREDICTIONS), layout.predictions_rf)
    overwrite_table(conformed(trees.score(gbt, rows), PREDICTIONS), layout.predictions_gbt)
    overwrite_table(scored_days(trusted, rf, gbt, settings), layout.scored_days)


def scored_days(trusted: DataFrame, rf: PipelineModel, gbt: PipelineModel, settings: Settings) -> DataFrame:
    """Rows with all features, and what both models predict for them as whole numbers."""
    complete = trusted.dropna(subset=list(settings.features))
    by_rf = trees.score(rf, complete).withColumnRenamed("predicted_incidents", "rf_incidents")
    return trees.score(gbt, by_rf).withColumnRenamed("predicted_incidents", "gbt_incidents")
