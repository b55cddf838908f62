"""External tables over the refined zone, served by dataset name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainlane import schemas
from rainlane.fixed_values import DATASETS
from rainlane.functions.text import text_columns
from rainlane.settings import Layout


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType
) -> DataFrame:
    """(Re)declare an external parquet table; its columns are found by name, so the
    declaration may name fewer than the files hold. One that is declared so already is only
    moved, so that it is never missing. A table or view of that name that isn't external is
    left alone, and raises."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is there already and no external table")
        if spark.table(name).schema.simpleString() == schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    return spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def dataset_tables(layout: Layout) -> dict[str, tuple[str, T.StructType]]:
    return {
        "congestion-stats": (layout.congestion_stats, schemas.CONGESTION_STATS),
        "global-stats": (layout.global_stats, schemas.GLOBAL_STATS),
        "correlations": (layout.correlations, schemas.CORRELATIONS),
        "visualizations": (layout.chart_metadata, schemas.CHART_METADATA),
        "test-data": (layout.scenario, schemas.SCENARIO),
        "model-evaluation": (layout.model_evaluation, schemas.MODEL_EVALUATION),
        "predictions-gbt": (layout.predictions_gbt, schemas.PREDICTIONS_SERVED),
        "predictions-rf": (layout.predictions_rf, schemas.PREDICTIONS_SERVED),
    }


def register_datasets(
    spark: SparkSession, layout: Layout, database: str, names: list[str] | None = None
) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = dataset_tables(layout)
    for name in names or tables:
        path, schema = tables[name]
        register_table(spark, f"{database}.{DATASETS[name]}", path, schema)


def serve(spark: SparkSession, name: str, database: str) -> DataFrame:
    """All rows and columns of a dataset."""
    table = DATASETS.get(name.lstrip("/"))
    if table is None:
        raise ValueError(f"unknown dataset {name!r}; available: {', '.join(sorted(DATASETS))}")
    return spark.table(f"{database}.{table}")


def as_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text whose values are all strings, '' where missing."""
    return df.select(F.to_json(F.struct(*text_columns(df))).alias("record"))
