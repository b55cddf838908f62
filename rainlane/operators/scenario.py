"""Scenario rows to be scored: consecutive days with weather and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane import fixed_values as fv
from rainlane.functions.naming import day_after, iso_date
from rainlane.schemas import SCENARIO
from rainlane.sinks.tables import conformed


def scenario(
    base: DataFrame,
    *,
    offset: Column,
    row_id: Column,
    max_temp: Column,
    precipitation: Column,
    level: Column,
    city: Column | None = None,
    start: str = fv.SCENARIO_START,
) -> DataFrame:
    """One scenario row per row of ``base``; ``offset`` is the number of days after ``start``."""
    return base.select(
        iso_date(day_after(start, offset)).alias("date"),
        row_id.alias("id"),
        (F.lit(fv.SCENARIO_CITY) if city is None else city).alias("city"),
        max_temp.alias("max_temp"),
        precipitation.alias("precipitation"),
        level.alias("congestion_level_num"),
    )


def default_scenario(spark: SparkSession, seed: int, days: int = fv.SCENARIO_DAYS) -> DataFrame:
    """``days`` consecutive days with ids 1 .. ``days`` and drawn weather and levels.

    The rows are made in one partition, for which the engine's seeded functions draw the
    same numbers each time.
    """
    drawn = scenario(
        spark.range(0, days, 1, 1),
        offset=F.col("id"),
        row_id=F.col("id") + 1,
        max_temp=F.round(F.randn(seed) * fv.SCENARIO_TEMP_SD + fv.SCENARIO_TEMP_MEAN, 1),
        precipitation=F.round(F.rand(seed + 1) * fv.SCENARIO_PRECIP_MAX, 2),
        level=F.floor(F.rand(seed + 2) * fv.SCENARIO_LEVELS) + 1,
    )
    return conformed(drawn, SCENARIO)
