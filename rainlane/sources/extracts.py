"""Relational extracts: CSV files with a header, and tables read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rainlane.schemas import INCIDENT_EXTRACT
from rainlane.sources.raw_files import STREAM_OPTIONS, checked, with_corrupt

# A header that differs from the schema raises instead of shifting columns;
# quotes inside a field are doubled. Whole lines are parsed, so that a line with a field
# too few or too many is found out whichever columns are wanted.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "escape": '"', "columnPruning": False}


def read_extract(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = INCIDENT_EXTRACT,
    multiline: bool = False,
    corrupt: str = "raise",
    sources: bool = False,
) -> DataFrame:
    """CSV files under a path or glob; an empty field is NULL. ``multiline`` reads
    fields with line breaks, at the price of one task per file. A line with a field too
    few or too many raises, or is kept as such."""
    reader = spark.read.schema(with_corrupt(schema)).options(**CSV_OPTIONS)
    return checked(reader.option("multiLine", multiline).csv(path), schema, corrupt, sources)


def stream_extract(
    spark: SparkSession,
    path: str,
    schema: T.StructType = INCIDENT_EXTRACT,
    files_per_batch: int | None = None,
    sources: bool = False,
    corrupt: str = "raise",
) -> DataFrame:
    """Lines of the files as they arrive below ``path``, which need not be there yet."""
    reader = spark.readStream.schema(with_corrupt(schema)).options(**CSV_OPTIONS, **STREAM_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return checked(reader.csv(f"{path}/*"), schema, corrupt, sources)


def read_relational_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    partitions: int,
    bounds: tuple[int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows and columns of a table, read by ``partitions`` tasks over ranges of
    the numeric column ``key``.

    Without ``bounds`` the database is asked for the lowest and highest key. The
    bounds only place the ranges, they filter nothing: the first and the last
    range are open, and rows with a NULL key come with the first. User and
    password belong in ``properties``.
    """
    options = dict(properties or {})
    if bounds is None:
        bounds = _key_range(spark, url, table, key, options)
    if bounds is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1] + 1,
        numPartitions=partitions,
        properties=options,
    )


def _key_range(
    spark: SparkSession, url: str, table: str, key: str, options: dict[str, str]
) -> tuple[int, int] | None:
    query = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) key_range"
    lo, hi = spark.read.jdbc(url, query, properties=options).first()
    return None if lo is None else (int(lo), int(hi))
