"""Between a document of parallel arrays and one row per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.functions.casting import lenient_date


def unpack_days(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row (date, max_temp, precipitation) per array position, with the columns of
    the document that ``carry`` names.

    A shorter array is padded with NULL; a document whose arrays are NULL or
    empty gives no row.
    """
    zipped = F.arrays_zip(
        F.col("daily.time").alias("time"),
        F.col("daily.temperature_2m_max").alias("temperature_2m_max"),
        F.col("daily.precipitation_sum").alias("precipitation_sum"),
    )
    rows = docs.select(*carry, F.inline(zipped).alias("time", "max_temp", "precipitation"))
    return rows.select(lenient_date("time").alias("date"), "max_temp", "precipitation", *carry)


def pack_documents(
    days: DataFrame, per: str = "year", place: dict | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Documents of parallel arrays, one per calendar year (or quarter, month, week) and
    place. ``place`` names the one place of all rows, ``by`` the columns that tell places
    apart, such as latitude and longitude, and give them to the document.

    A date that occurs twice in a place raises, so a document holds at most 366 values.
    """
    place, by = place or {}, list(by)
    single = F.col("_n") == 1
    repeated = F.raise_error(F.concat(F.lit("more than one row for "), F.col("date").cast("string")))
    series = (
        days.groupBy(*by, "date")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.any_value("max_temp").alias("max_temp"),
            F.any_value("precipitation").alias("precipitation"),
        )
        .withColumn("date", F.when(single, F.col("date")).otherwise(repeated.cast("date")))
        .groupBy(*by, F.trunc("date", per).alias("_doc"))
        .agg(F.array_sort(F.collect_list(F.struct("date", "max_temp", "precipitation"))).alias("_s"))
    )
    iso = F.transform("_s", lambda e: F.date_format(e["date"], "yyyy-MM-dd"))

    def scalar(name: str, dtype: str) -> Column:
        value = F.col(name) if name in by else F.lit(place.get(name))
        return value.cast(dtype).alias(name)

    return series.select(
        scalar("latitude", "double"),
        scalar("longitude", "double"),
        scalar("generationtime_ms", "double"),
        scalar("utc_offset_seconds", "bigint"),
        scalar("timezone", "string"),
        scalar("timezone_abbreviation", "string"),
        scalar("elevation", "double"),
        F.struct(
            F.lit("iso8601").alias("time"),
            F.lit("°C").alias("temperature_2m_max"),
            F.lit("mm").alias("precipitation_sum"),
        ).alias("daily_units"),
        F.struct(
            iso.alias("time"),
            F.col("_s.max_temp").alias("temperature_2m_max"),
            F.col("_s.precipitation").alias("precipitation_sum"),
        ).alias("daily"),
    )
