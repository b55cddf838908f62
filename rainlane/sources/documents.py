"""Nested weather documents: one JSON object per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainlane.schemas import WEATHER_DOCUMENT
from rainlane.sources.raw_files import STREAM_OPTIONS, checked, with_corrupt


def read_weather_documents(
    spark: SparkSession, path: str | list[str], corrupt: str = "raise", sources: bool = False
) -> DataFrame:
    """Documents under a path or glob; an object may span several lines. A document that is
    no sound JSON raises, or is kept as such."""
    reader = spark.read.schema(with_corrupt(WEATHER_DOCUMENT)).option("multiLine", True)
    return checked(reader.json(path), WEATHER_DOCUMENT, corrupt, sources)


def stream_weather_documents(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    sources: bool = False,
    corrupt: str = "raise",
) -> DataFrame:
    """Documents as they arrive below ``path``, which need not be there yet."""
    reader = spark.readStream.schema(with_corrupt(WEATHER_DOCUMENT)).option("multiLine", True)
    reader = reader.options(**STREAM_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return checked(reader.json(f"{path}/*"), WEATHER_DOCUMENT, corrupt, sources)
