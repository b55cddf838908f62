"""Trusted -> chart datasets and their metadata."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.fixed_values import CHARTS
from rainlane.operators.metadata import chart_descriptions, chart_metadata
from rainlane.plans.analysis import analyse
from rainlane.settings import Layout, Settings
from rainlane.sinks.tables import append_table
from rainlane.sources.artifacts import artifact_files


def chart_datasets(trusted: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The dataset of each chart, by chart kind."""
    return analyse(trusted, settings).datasets


def write_charts(
    spark: SparkSession,
    datasets: Mapping[str, DataFrame],
    layout: Layout,
    run_time: datetime,
    before: DataFrame | None = None,
) -> None:
    """Write each dataset as a JSON artifact and append their metadata. ``before``: metadata
    that the table of another run has, to go on with."""
    stamp = f"{run_time:%Y%m%d_%H%M%S}"
    run_folder = f"{layout.charts}/{stamp}"
    for kind, data in datasets.items():
        data.write.mode("overwrite").json(f"{run_folder}/{CHARTS[kind]['artifact']}")
    metadata = chart_metadata(
        chart_descriptions(spark), run_files(spark, run_folder), layout.charts, F.lit(stamp)
    )
    append_table(metadata if before is None else before.unionByName(metadata), layout.chart_metadata)


def run_files(spark: SparkSession, run_folder: str) -> DataFrame:
    """Artifact files of a run; the folder of a file is its key."""
    return artifact_files(spark, run_folder, "*.json").withColumn(
        "key", F.element_at(F.split("location", "/"), -2)
    )
