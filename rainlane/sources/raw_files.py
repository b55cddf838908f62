"""What both kinds of raw files have in common: versions, sources of rows, corrupt input."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainlane.schemas import FILE_VERSION, TEXT

CORRUPT = "_corrupt_record"
# A stream leaves out files much older than its newest one unless it is told not to.
STREAM_OPTIONS = {"maxFileAge": "36500d"}


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column that takes in what could not be read by it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, TEXT)])


def checked(rows: DataFrame, schema: T.StructType, corrupt: str, sources: bool) -> DataFrame:
    """Rows of a scan by ``with_corrupt(schema)``. ``corrupt`` is "raise", or "keep" to have
    corrupt rows with their text in ``_corrupt_record``, to be counted and put aside.
    ``sources`` adds the file of each row and its modification time."""
    if corrupt not in ("raise", "keep"):
        raise ValueError(f"corrupt is 'raise' or 'keep', not {corrupt!r}")
    columns = schema.fieldNames()
    if corrupt == "keep":
        columns = [*columns, CORRUPT]
    else:
        # A scan for the corrupt column alone is refused, so the message names another too.
        message = F.concat(
            F.lit("corrupt input in "),
            F.col("_metadata.file_path"),
            F.lit(": "),
            F.coalesce(F.col(schema.fieldNames()[-1]).cast("string"), F.lit("")),
            F.lit(" "),
            F.substring(CORRUPT, 1, 200),
        )
        sound = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        rows = rows.where(sound)
    version = [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
    ]
    return rows.select(*columns, *(version if sources else []))


def file_versions(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` and when they were last written; their content is not read. A
    path that is not there, as a prefix without objects, has no files."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_VERSION)
    return found.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
    )
