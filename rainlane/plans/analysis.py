"""All descriptive tables and chart datasets from two or three passes over the trusted table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from rainlane.operators import charts, summary
from rainlane.schemas import CONGESTION_STATS, CORRELATIONS, GLOBAL_STATS
from rainlane.settings import Settings
from rainlane.sinks.tables import conformed
from rainlane.staging import stage


@dataclass(frozen=True)
class Analysis:
    tables: dict[str, DataFrame]
    datasets: dict[str, DataFrame]


def overview_columns() -> list[Column]:
    """Global statistics, correlations and the ends of the binned columns, for one row."""
    binned = list(charts.CUBE_AXES.values())
    return [*summary.global_columns(), *summary.correlation_columns(), *charts.span_columns(binned)]


def analyse(trusted: DataFrame, settings: Settings, overview: DataFrame | None = None) -> Analysis:
    """All of them; give it a written table, as it is read three times.

    The first pass makes the row of ``overview_columns``; it is spared if ``overview`` is that
    row, as noted while the table was written. The second makes the row of the correlation matrix;
    one aggregate of both would be too wide for generated code and slower than
    two. The third makes the cube of totals per bin and level. All are small
    written tables, from which everything else is read.
    """
    variables = [settings.label, *settings.features]
    binned = list(charts.CUBE_AXES.values())
    one_row = stage(trusted.agg(*overview_columns()) if overview is None else overview, "overview")
    matrix_row = stage(trusted.agg(*summary.matrix_columns(variables)), "matrix")
    edges = charts.edges_from(one_row.first(), binned, settings.bins)
    cube = stage(charts.incident_cube(trusted, edges), "incident-cube")
    value, level = settings.label, "congestion_level_num"
    return Analysis(
        tables={
            "global_stats": conformed(one_row, GLOBAL_STATS),
            "congestion_stats": conformed(charts.cube_level_stats(cube), CONGESTION_STATS),
            "correlations": conformed(one_row, CORRELATIONS),
        },
        datasets={
            "temp_incidents_bar": charts.cube_bars(cube, "temp", value, level),
            "precip_incidents_bar": charts.cube_bars(cube, "precip", value, level),
            "correlation_heatmap": summary.matrix_rows(matrix_row, variables),
            "congestion_incidents_bar": charts.cube_totals(cube, level),
        },
    )
