"""Declared schemas of every dataset; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIME, FLAG = T.DateType(), T.TimestampType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


WEATHER_DOCUMENT = struct(
    latitude=DOUBLE,
    longitude=DOUBLE,
    generationtime_ms=DOUBLE,
    utc_offset_seconds=LONG,
    timezone=TEXT,
    timezone_abbreviation=TEXT,
    elevation=DOUBLE,
    daily_units=struct(time=TEXT, temperature_2m_max=TEXT, precipitation_sum=TEXT),
    daily=struct(
        time=T.ArrayType(TEXT),
        temperature_2m_max=T.ArrayType(DOUBLE),
        precipitation_sum=T.ArrayType(DOUBLE),
    ),
)

INCIDENT_EXTRACT = struct(
    id=TEXT, city=TEXT, reported_incidents=TEXT, congestion_level=TEXT, incident_date=TEXT
)

WEATHER_DAYS = struct(date=DATE, max_temp=DOUBLE, precipitation=DOUBLE)

INCIDENTS = struct(
    id=TEXT, city=TEXT, reported_incidents=WHOLE, date=DATE, congestion_level_num=WHOLE
)

# Which state of which raw file a landed row comes from.
FILE_VERSION = struct(source_file=TEXT, source_time=TIME)


def landed(rows: T.StructType) -> T.StructType:
    """Landed rows: typed, with their source, and stored by month."""
    return T.StructType([*rows.fields, *FILE_VERSION.fields, T.StructField("month", DATE)])


TRUSTED = struct(
    date=DATE,
    id=TEXT,
    city=TEXT,
    reported_incidents=WHOLE,
    max_temp=DOUBLE,
    precipitation=DOUBLE,
    congestion_level_num=WHOLE,
)

GLOBAL_STATS = struct(
    min_incidents=WHOLE,
    max_incidents=WHOLE,
    avg_incidents=DOUBLE,
    std_incidents=DOUBLE,
    min_temp=DOUBLE,
    max_temp=DOUBLE,
    avg_temp=DOUBLE,
    min_precip=DOUBLE,
    max_precip=DOUBLE,
    avg_precip=DOUBLE,
)

CONGESTION_STATS = struct(
    congestion_level_num=WHOLE,
    days_count=LONG,
    avg_incidents=DOUBLE,
    avg_temp=DOUBLE,
    avg_precip=DOUBLE,
)

CORRELATIONS = struct(temp_corr=DOUBLE, precip_corr=DOUBLE, congestion_corr=DOUBLE)

CHART_METADATA = struct(
    visualization_id=TEXT,
    title=TEXT,
    visualization_type=TEXT,
    s3_location=TEXT,
    file_size_kb=DOUBLE,
    dimensions=struct(width=WHOLE, height=WHOLE),
    related_data=struct(temperature=FLAG, precipitation=FLAG, congestion=FLAG, correlation=FLAG),
    parameters=T.MapType(TEXT, TEXT),
)

# What the driver knows of a chart before its artifact is measured.
CHART_DESCRIPTION = struct(
    visualization_type=TEXT,
    title=TEXT,
    key=TEXT,
    dimensions=struct(width=WHOLE, height=WHOLE),
    related_data=struct(temperature=FLAG, precipitation=FLAG, congestion=FLAG, correlation=FLAG),
    parameters=T.MapType(TEXT, TEXT),
)

MODEL_EVALUATION = struct(
    model=TEXT, rmse=DOUBLE, mae=DOUBLE, best_model=TEXT, evaluation_timestamp=TIME
)

SCENARIO = struct(
    date=TEXT,
    id=WHOLE,
    city=TEXT,
    max_temp=DOUBLE,
    precipitation=DOUBLE,
    congestion_level_num=WHOLE,
)

PREDICTIONS = struct(
    **{f.name: f.dataType for f in SCENARIO.fields}, predicted_incidents=WHOLE
)

# The served prediction tables declare four of the seven written columns.
PREDICTIONS_SERVED = struct(
    congestion_level_num=WHOLE, max_temp=DOUBLE, precipitation=DOUBLE, predicted_incidents=WHOLE
)
