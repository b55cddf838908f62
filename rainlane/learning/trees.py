"""Tree-ensemble regression with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.functions.casting import rounded_int
from rainlane.learning.prefixes import PrefixPipeline
from rainlane.schemas import DOUBLE, struct
from rainlane.settings import Settings
from rainlane.staging import shared_dir, stage

LABEL = "label"
WEIGHT = "weight"


def assembler(features: tuple[str, ...], invalid: str = "error") -> VectorAssembler:
    """``invalid``: "error" refuses rows with missing features, "skip" leaves them
    out, "keep" passes NaN on."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


def labelled(trusted: DataFrame, settings: Settings, *more: str) -> DataFrame:
    """Only the columns a fit reads, with the target renamed, and those of ``more``."""
    named = trusted.withColumnRenamed(settings.label, LABEL)
    return named.select(LABEL, *settings.features, *more)


def fit_table(rows: DataFrame, settings: Settings, name: str) -> DataFrame:
    """``rows`` written with about ``settings.rows_per_fit_task`` to a task. Fits are many short
    jobs; a task for a few rows would only add to each of them."""
    written = stage(rows, name)
    return stage(written.repartition(max(1, written.count() // settings.rows_per_fit_task)), name)


def counted(rows: DataFrame, least: int = 1) -> DataFrame:
    """Equal rows as one, with their number as its weight: what trees and metrics add up over
    weighted rows are the totals of all rows.

    Nodes hold against ``minInstancesPerNode`` their rows, not the weight of these. So up to
    ``least`` of the equal rows stay, of which the first has the weight of all that don't; a node
    then has k rows, for any k up to ``least``, where it has k of the rows that came in. Fits that draw
    rows, as bootstrap does, need the rows themselves.
    """
    n = F.col("_n")
    stay = F.least(n, F.lit(least))
    weights = F.concat(F.array(n - stay + 1), F.array_repeat(F.lit(1).cast("bigint"), (stay - 1).cast("int")))
    return (
        rows.groupBy(*rows.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*rows.columns, F.explode(weights.cast("array<double>")).alias(WEIGHT))
    )


def forest(settings: Settings, **params) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, seed=settings.seed, **params
    )


def boosted(settings: Settings, **params) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=LABEL, seed=settings.seed, **params)


def regression_chain(regressor, settings: Settings) -> PrefixPipeline:
    return PrefixPipeline(stages=[assembler(settings.features), regressor])


def param_grid(regressor, grid: Mapping[str, tuple]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(regressor, name), list(values))
    return builder.build()


def cross_validated(
    regressor, grid: Mapping[str, tuple], settings: Settings, fold_column: str = ""
) -> CrossValidator:
    """K-fold search by RMSE; the fits of one fold run side by side, one for all sizes of an
    ensemble. ``fold_column`` names a column with the fold of each row, 0 to folds - 1;
    without it folds are drawn. The metric weighs rows as the regressor does."""
    evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="rmse")
    if regressor.isSet(regressor.weightCol):
        evaluator.setWeightCol(regressor.getWeightCol())
    return CrossValidator(
        foldCol=fold_column,
        estimator=regression_chain(regressor, settings),
        estimatorParamMaps=param_grid(regressor, grid),
        evaluator=evaluator,
        numFolds=settings.grids.folds,
        seed=settings.seed,
        parallelism=settings.grids.parallelism,
    )


def prepare_checkpoints(spark: SparkSession) -> None:
    """Long boosting runs cut their lineage every few iterations; that needs a
    checkpoint folder, which is the shared one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def search_results(spark: SparkSession, fitted: CrossValidatorModel, grid: Mapping[str, tuple]) -> DataFrame:
    """Mean RMSE per parameter setting: one small row per point of the grid."""
    settings = list(product(*grid.values()))
    rows = [
        (*(float(v) for v in values), float(rmse))
        for values, rmse in zip(settings, _in_grid_order(fitted, grid, settings))
    ]
    return spark.createDataFrame(rows, struct(**dict.fromkeys(grid, DOUBLE), avg_rmse=DOUBLE))


def _in_grid_order(fitted: CrossValidatorModel, grid: Mapping[str, tuple], settings: list) -> list:
    by_values = {}
    for param_map, rmse in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        named = {param.name: value for param, value in param_map.items()}
        by_values[tuple(named[name] for name in grid)] = rmse
    return [by_values[values] for values in settings]


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows plus the prediction rounded to a whole number."""
    scored = model.transform(rows)
    return scored.select(*rows.columns, rounded_int("prediction").alias("predicted_incidents"))
