"""Raw -> trusted: typed weather days joined with typed incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainlane.functions.casting import lenient_date, lenient_int
from rainlane.functions.encoding import ordinal_code
from rainlane.operators.joining import join_measured
from rainlane.schemas import TRUSTED
from rainlane.settings import Settings


def typed_incidents(extract: DataFrame, settings: Settings) -> DataFrame:
    """Text columns to types, label to code; other columns stay as they are.

    The projection comes before the join, so that a shuffle moves only what the
    result keeps.
    """
    return (
        extract.withColumns(
            {
                "date": lenient_date("incident_date"),
                "reported_incidents": lenient_int("reported_incidents"),
                "congestion_level_num": ordinal_code(
                    F.col("congestion_level"), settings.level_codes, settings.level_default
                ),
            }
        )
        .drop("congestion_level", "incident_date")
    )


def build_trusted(days: DataFrame, extract: DataFrame, settings: Settings) -> DataFrame:
    """Incidents with the weather of their day.

    Inner join: days without incidents, incidents without a weather day and
    rows without a valid date are left out; a date that occurs several times on
    the weather side multiplies its incidents.
    """
    return join_typed(days, typed_incidents(extract, settings), settings)


def join_typed(days: DataFrame, incidents: DataFrame, settings: Settings) -> DataFrame:
    joined = join_measured(
        incidents.where(F.col("date").isNotNull()),
        days.where(F.col("date").isNotNull()),
        settings.join_keys,
        settings.broadcast_max_bytes,
    )
    extra = [c for c in joined.columns if c not in TRUSTED.fieldNames()]
    return joined.select(*TRUSTED.fieldNames(), *extra)
