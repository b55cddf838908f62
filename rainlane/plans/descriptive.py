"""Trusted -> the three descriptive tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from rainlane.plans.analysis import analyse
from rainlane.settings import Layout, Settings
from rainlane.sinks.tables import overwrite_table


def descriptive(trusted: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """Global statistics, statistics per level, correlations."""
    return analyse(trusted, settings or Settings()).tables


def write_descriptive(tables: Mapping[str, DataFrame], layout: Layout) -> None:
    overwrite_table(tables["global_stats"], layout.global_stats)
    overwrite_table(tables["congestion_stats"], layout.congestion_stats)
    overwrite_table(tables["correlations"], layout.correlations)
