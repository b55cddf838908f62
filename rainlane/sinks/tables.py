"""Parquet sinks of the trusted and refined zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the declared columns, order and types, so that the files agree
    with the tables declared over them."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "snappy").parquet(path)
