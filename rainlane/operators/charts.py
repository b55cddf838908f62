"""Datasets behind the charts; the drawing itself needs no cluster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rainlane.functions.binning import bin_edges, equal_width_bin
from rainlane.functions.casting import known

CUBE_AXES = {"temp": "max_temp", "precip": "precipitation"}


def span_columns(columns: Sequence[str]) -> list[Column]:
    """Lowest and highest value of each column, missing values left out."""
    return [
        end(known(c)).alias(f"{name}_{c}")
        for c in columns
        for name, end in (("lo", F.min), ("hi", F.max))
    ]


def edges_from(spans: Row, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Bin edges of each column that has a value."""
    return {
        c: bin_edges(spans[f"lo_{c}"], spans[f"hi_{c}"], bins)
        for c in columns
        if spans[f"lo_{c}"] is not None
    }


def edges_of(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """The same from one pass over all columns; only their ends come to the driver."""
    return edges_from(df.agg(*span_columns(columns)).first(), columns, bins)


def bin_of(column: str, edges: Mapping[str, list[float]]) -> Column:
    """Bin number of ``column``, NULL where the value is missing."""
    if column not in edges:
        return F.lit(None).cast("int")
    return equal_width_bin(known(column), edges[column])


def with_bin(df: DataFrame, column: str, bins: int, name: str) -> DataFrame:
    return df.withColumn(name, bin_of(column, edges_of(df, [column], bins)))


def binned_mean(df: DataFrame, column: str, bins: int, value: str, hue: str) -> DataFrame:
    """Mean of ``value`` and row count per (bin of ``column``, ``hue``), with bin ends.

    Rows without a bin are not charted; combinations without rows are absent.
    """
    edges = edges_of(df, [column], bins)
    bars = (
        df.where(known(column).isNotNull() & F.col(hue).isNotNull())
        .groupBy(bin_of(column, edges).alias("bin"), hue)
        .agg(
            F.try_divide(
                F.sum(F.col(value).cast("bigint")).cast("double"), F.count(value)
            ).alias(f"mean_{value}"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    lower, upper = _ends(F.col("bin"), edges.get(column))
    return bars.select(
        "bin", lower.alias("lower"), upper.alias("upper"), hue, f"mean_{value}", "n_rows"
    )


def level_totals(df: DataFrame, value: str, level: str) -> DataFrame:
    """Total of ``value`` per level, the level being a text category."""
    return df.groupBy(level).agg(F.sum(F.col(value).cast("bigint")).alias("total_incidents")).select(
        F.col(level).cast("string").alias("congestion_level_str"), "total_incidents"
    )


def incident_cube(df: DataFrame, edges: Mapping[str, list[float]]) -> DataFrame:
    """Totals and counts per (temperature bin, precipitation bin, level).

    One pass gives a table of at most (bins + 1)^2 rows per level, from which
    all bar charts and the statistics per level follow.
    """
    cube = df.groupBy(
        *(bin_of(column, edges).alias(f"{axis}_bin") for axis, column in CUBE_AXES.items()),
        "congestion_level_num",
    ).agg(
        F.sum(F.col("reported_incidents").cast("bigint")).alias("total"),
        F.count("reported_incidents").alias("present"),
        F.count(F.lit(1)).alias("n_rows"),
        *(F.sum(column).alias(f"{axis}_total") for axis, column in CUBE_AXES.items()),
        *(F.count(column).alias(f"{axis}_present") for axis, column in CUBE_AXES.items()),
    )
    for axis, column in CUBE_AXES.items():
        lower, upper = _ends(F.col(f"{axis}_bin"), edges.get(column))
        cube = cube.withColumns({f"{axis}_lower": lower, f"{axis}_upper": upper})
    return cube


def cube_bars(cube: DataFrame, axis: str, value: str, hue: str) -> DataFrame:
    """The bars of one binned chart, from the cube (``axis`` is temp or precip)."""
    return (
        cube.where(F.col(f"{axis}_bin").isNotNull() & F.col(hue).isNotNull())
        .groupBy(
            F.col(f"{axis}_bin").alias("bin"),
            F.col(f"{axis}_lower").alias("lower"),
            F.col(f"{axis}_upper").alias("upper"),
            hue,
        )
        .agg(
            F.try_divide(F.sum("total").cast("double"), F.sum("present")).alias(f"mean_{value}"),
            F.sum("n_rows").alias("n_rows"),
        )
    )


def cube_totals(cube: DataFrame, level: str) -> DataFrame:
    return cube.groupBy(level).agg(F.sum("total").alias("total_incidents")).select(
        F.col(level).cast("string").alias("congestion_level_str"), "total_incidents"
    )


def cube_level_stats(cube: DataFrame) -> DataFrame:
    """Days and means per congestion level, ordered by level."""

    def mean(total: str, present: str) -> Column:
        return F.try_divide(F.sum(total).cast("double"), F.sum(present))

    return (
        cube.groupBy("congestion_level_num")
        .agg(
            F.sum("n_rows").alias("days_count"),
            mean("total", "present").alias("avg_incidents"),
            mean("temp_total", "temp_present").alias("avg_temp"),
            mean("precip_total", "precip_present").alias("avg_precip"),
        )
        .orderBy("congestion_level_num")
    )


def _ends(bin_number: Column, edges: list[float] | None) -> tuple[Column, Column]:
    if edges is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    all_edges = F.array(*map(F.lit, edges))
    return F.get(all_edges, bin_number), F.get(all_edges, bin_number + 1)
