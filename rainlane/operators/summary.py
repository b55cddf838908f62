"""Descriptive statistics of the trusted table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.functions.casting import known
from rainlane.functions.correlation import clipped, pearson


def global_columns() -> list[Column]:
    incidents, temp, precip = F.col("reported_incidents"), F.col("max_temp"), F.col("precipitation")
    return [
        F.min(incidents).cast("int").alias("min_incidents"),
        F.max(incidents).cast("int").alias("max_incidents"),
        F.avg(incidents).cast("double").alias("avg_incidents"),
        F.stddev_samp(incidents).cast("double").alias("std_incidents"),
        F.min(temp).cast("double").alias("min_temp"),
        F.max(temp).cast("double").alias("max_temp"),
        F.avg(temp).cast("double").alias("avg_temp"),
        F.min(precip).cast("double").alias("min_precip"),
        F.max(precip).cast("double").alias("max_precip"),
        F.avg(precip).cast("double").alias("avg_precip"),
    ]


def correlation_columns() -> list[Column]:
    """By the rule of the matrix: missing and NaN values are left out, results clipped."""
    incidents = known("reported_incidents")
    others = {
        "temp_corr": "max_temp",
        "precip_corr": "precipitation",
        "congestion_corr": "congestion_level_num",
    }
    return [clipped(pearson(incidents, known(c))).alias(a) for a, c in others.items()]


def global_stats(trusted: DataFrame) -> DataFrame:
    return trusted.agg(*global_columns())


def correlations(trusted: DataFrame) -> DataFrame:
    return trusted.agg(*correlation_columns())


def level_stats(trusted: DataFrame) -> DataFrame:
    """Days and means per congestion level, ordered by level."""
    return (
        trusted.groupBy("congestion_level_num")
        .agg(
            F.count(F.lit(1)).alias("days_count"),
            F.avg("reported_incidents").alias("avg_incidents"),
            F.avg("max_temp").alias("avg_temp"),
            F.avg("precipitation").alias("avg_precip"),
        )
        .orderBy("congestion_level_num")
    )


def matrix_columns(variables: Sequence[str]) -> list[Column]:
    """The aggregates from which ``matrix_rows`` makes the correlation matrix."""
    values = {v: known(v) for v in variables}
    return [F.stddev_pop(values[v]).alias(f"sd_{v}") for v in variables] + [
        pearson(values[a], values[b]).alias(f"r_{a}_{b}") for a, b in combinations(variables, 2)
    ]


def matrix_rows(one_row: DataFrame, variables: Sequence[str]) -> DataFrame:
    """All pairs as rows (row_var, col_var, r)."""

    def cell(a: str, b: str) -> Column:
        if a == b:
            r = F.when(F.col(f"sd_{a}") > 0, F.lit(1.0))
        else:
            first, second = sorted((a, b), key=list(variables).index)
            r = clipped(F.col(f"r_{first}_{second}"))
        return F.struct(F.lit(a).alias("row_var"), F.lit(b).alias("col_var"), r.alias("r"))

    return one_row.select(F.inline(F.array(*(cell(a, b) for a in variables for b in variables))))


def correlation_matrix(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Full Pearson matrix in long form, from one pass over the data.

    Each pair uses the rows where both values are present. A variable without
    variance has no correlation, also not with itself.
    """
    return matrix_rows(df.agg(*matrix_columns(variables)), variables)
