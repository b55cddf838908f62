"""Star-schema sample tables seen as weather days and incident extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS_CODES = {"F": 1, "O": 2}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def weather_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shipping day. Quantities are whole numbers, so the mean does not
    depend on the order of the rows."""
    return (
        star_table(spark, folder, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.avg("l_quantity").alias("max_temp"),
            F.max("l_extendedprice").alias("precipitation"),
        )
    )


def incident_extract(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, all columns text, as an extract file holds them."""
    return star_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("city"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("reported_incidents"),
        F.col("o_orderstatus").alias("congestion_level"),
        F.col("o_orderdate").cast("date").cast("string").alias("incident_date"),
    )
