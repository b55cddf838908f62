"""Files written by a run, as a table of location and size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.functions.naming import kilobytes


def artifact_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file below ``path``; the content column is pruned, so only the
    file listing is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("path").alias("location"), kilobytes(F.col("length")).alias("file_size_kb")
    )
