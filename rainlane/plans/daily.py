"""The whole run: raw -> trusted -> descriptive tables, charts, models."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rainlane.catalog.published import MODELS, current_runs, publish
from rainlane.fixed_values import MODEL_GBT, MODEL_RF
from rainlane.learning.store import load_models
from rainlane.operators.counts import counted_stages
from rainlane.operators.unpack import unpack_days
from rainlane.plans.analysis import analyse, overview_columns
from rainlane.plans.charting import write_charts
from rainlane.plans.descriptive import write_descriptive
from rainlane.plans.forecasting import write_forecast, write_scores
from rainlane.plans.trusted import join_typed, typed_incidents
from rainlane.schemas import CHART_METADATA, FILE_VERSION, TRUSTED
from rainlane.settings import Layout, Settings
from rainlane.sinks.tables import overwrite_table
from rainlane.sources.documents import read_weather_documents
from rainlane.sources.extracts import read_extract
from rainlane.sources.raw_files import CORRUPT
from rainlane.sources.tables import read_table
from rainlane.staging import own_folders, stage
from rainlane.streaming.refresh import note_refined, refined_state, take_in, trusted_by_month, trusted_state


def write_trusted(spark: SparkSession, layout: Layout, settings: Settings) -> DataFrame | None:
    """Build the trusted table, and write the number of rows at each stage of it.

    Returns the row of ``overview_columns`` as it was noted while the rows were written, or
    None where there was nothing to note. With ``settings.corrupt`` "set_aside" input that
    can't be read is written to ``layout.raw_rejected`` and counted as a stage of its own.
    """
    mode = settings.corrupt_mode
    docs = read_weather_documents(spark, layout.raw_weather, mode, sources=mode == "keep")
    extract = read_extract(spark, layout.raw_incidents, corrupt=mode, sources=mode == "keep")
    noted = Observation("overview")
    with counted_stages(spark, layout.stage_counts) as count:
        if mode == "keep":
            docs, extract = (_set_aside(rows, layout, side, count) for rows, side in ((docs, "weather"), (extract, "incidents")))
        days = count(unpack_days(count(docs, "weather_documents")), "weather_days")
        joined = join_typed(days, count(typed_incidents(extract, settings), "incident_rows"), settings)
        joined = joined.observe(noted, *overview_columns())
        overwrite_table(count(joined, "joined_rows"), layout.trusted)
    # The plan ends in a write of these rows without a shuffle, so each task counts once.
    row = noted.get
    schema = read_table(spark, layout.trusted, TRUSTED).agg(*overview_columns()).schema
    if set(row) != set(schema.fieldNames()):
        return None
    return spark.createDataFrame([tuple(row[name] for name in schema.fieldNames())], schema)


def _set_aside(rows: DataFrame, layout: Layout, side: str, count: Callable) -> DataFrame:
    """The sound ones of ``rows``; the others are written down first."""
    rows = stage(rows, f"raw-{side}")
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(*FILE_VERSION.fieldNames(), F.col(CORRUPT).alias("record"))
    overwrite_table(count(bad, f"rejected_{side}"), layout.raw_rejected(side))
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, *FILE_VERSION.fieldNames())


#: Served datasets that need no models, and those that do.
DESCRIPTIVE = ("congestion-stats", "global-stats", "correlations", "visualizations")
SCORED = ("test-data", "predictions-gbt", "predictions-rf")


def refine(
    trusted: DataFrame,
    layout: Layout,
    settings: Settings,
    database: str | None = None,
    with_models: bool = True,
    overview: DataFrame | None = None,
) -> None:
    """All refined tables from the trusted one, written to a folder of this run and published
    together at the end; with ``database`` they are registered there for serving.

    Whatever fails on the way, the tables that were served before still are, as they were.
    Without ``with_models`` nothing is fitted; the models that were published last, if there
    are any, score the scenario and the trusted days.
    """
    spark, run_time = trusted.sparkSession, datetime.now(timezone.utc)
    run = f"{run_time:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    own, runs = layout.of_run(run), current_runs(spark, layout)
    analysis = analyse(trusted, settings, overview)
    write_descriptive(analysis.tables, own)
    before = runs.get("visualizations")
    charted = None if before is None else read_table(spark, layout.of_run(before).chart_metadata, CHART_METADATA)
    write_charts(spark, analysis.datasets, own, run_time, charted)
    names = [*DESCRIPTIVE]
    if with_models:
        write_forecast(trusted, own, settings, run_time)
        names += [*SCORED, "model-evaluation", MODELS]
    elif MODELS in runs:
        models = load_models(spark, layout.of_run(runs[MODELS]))
        write_scores(trusted, models[MODEL_RF], models[MODEL_GBT], own, settings)
        names += SCORED
    publish(spark, layout, run, names, database, settings.keep_runs)


def run_daily(
    spark: SparkSession,
    layout: Layout,
    settings: Settings | None = None,
    database: str | None = None,
    with_models: bool = True,
) -> None:
    """Run the steps in order in one session; any error ends the run."""
    settings = settings or Settings()
    with own_folders(spark):
        overview = write_trusted(spark, layout, settings)
        refine(read_table(spark, layout.trusted, TRUSTED), layout, settings, database, with_models, overview)


def run_on_arrival(
    spark: SparkSession,
    layout: Layout,
    settings: Settings | None = None,
    database: str | None = None,
    with_models: bool = True,
) -> bool:
    """The same for what has changed in the raw zone; nothing changed, no run.

    Returns whether the tables were refined. A run that failed on the way is
    taken up again by the next call. Without ``with_models`` the models, which
    are fitted on the whole table, are left to the daily run; its stored ones score.
    """
    settings = settings or Settings()
    with own_folders(spark):
        take_in(spark, layout, settings)
        state = trusted_state(spark, layout)
        if state == refined_state(spark, layout):
            return False
        refine(trusted_by_month(spark, layout), layout, settings, database, with_models)
        note_refined(spark, layout, state)
    return True
