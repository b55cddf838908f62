"""Metadata table of the chart artifacts of one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.fixed_values import CHARTS
from rainlane.functions.naming import artifact_id, artifact_location
from rainlane.schemas import CHART_DESCRIPTION, CHART_METADATA


def chart_descriptions(spark: SparkSession) -> DataFrame:
    """One row per chart, from the fixed descriptions."""
    topics = ("temperature", "precipitation", "congestion", "correlation")
    rows = [
        (
            kind,
            c["title"],
            c["artifact"],
            (c["width"], c["height"]),
            tuple(topic in c["related"] for topic in topics),
            c["parameters"],
        )
        for kind, c in CHARTS.items()
    ]
    return spark.createDataFrame(rows, CHART_DESCRIPTION)


def chart_metadata(
    descriptions: DataFrame, files: DataFrame, base: str, stamp: Column
) -> DataFrame:
    """Metadata rows of the run named by ``stamp``.

    ``files`` holds (key, location, file_size_kb) of its artifacts; one of
    several part files counts with their total size.
    """
    sizes = files.groupBy("key").agg(F.sum("file_size_kb").alias("file_size_kb"))
    return (
        descriptions.join(sizes, "key", "left")
        .select(
            artifact_id(F.col("visualization_type"), stamp).alias("visualization_id"),
            "title",
            "visualization_type",
            artifact_location(base, F.concat_ws("/", stamp, "key")).alias("s3_location"),
            "file_size_kb",
            "dimensions",
            "related_data",
            "parameters",
        )
        .to(CHART_METADATA)
    )
