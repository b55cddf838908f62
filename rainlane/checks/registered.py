"""Queries over the star-schema tables: orders stand for incidents, shipped line
items per day for the weather. Each one runs over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.catalog.datasets import as_records, register_datasets, register_table, serve
from rainlane.fixed_values import CHARTS, MODEL_GBT, MODEL_RF
from rainlane.functions import casting, naming
from rainlane.functions.encoding import ordinal_code
from rainlane.learning import trees
from rainlane.learning.store import load_models, save_models
from rainlane.operators import charts, metrics, splitting, summary
from rainlane.operators.counts import STAGE_COUNTS
from rainlane.operators.joining import sliced_join
from rainlane.operators.metadata import chart_descriptions, chart_metadata
from rainlane.operators.scenario import scenario
from rainlane.operators.unpack import pack_documents, unpack_days
from rainlane.plans.analysis import analyse
from rainlane.plans.charting import chart_datasets, run_files
from rainlane.plans.daily import DESCRIPTIVE, run_daily, write_trusted
from rainlane.plans.descriptive import descriptive, write_descriptive
from rainlane.plans.forecasting import fit_and_report, holdout_scores, model_rows, scored_days, train_eval
from rainlane.plans.trusted import build_trusted, typed_incidents
from rainlane.schemas import LONG, TEXT, struct
from rainlane.settings import Layout, Settings, TreeGrids
from rainlane.sinks.raw import land_documents, land_extract
from rainlane.sinks.tables import append_table, overwrite_table
from rainlane.sources.artifacts import artifact_files
from rainlane.sources.documents import read_weather_documents
from rainlane.sources.extracts import read_extract
from rainlane.sources.star_tables import STATUS_CODES, incident_extract, star_table, weather_days
from rainlane.sources.tables import read_table
from rainlane.staging import new_folder, stage
from rainlane.streaming.arrivals import ingest_incidents
from rainlane.streaming.ledger import arrival_counts
from rainlane.streaming.refresh import catch_up, listings_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LEVEL = "congestion_level_num"
VALUE = "reported_incidents"
PLACE = {"latitude": 6.25, "longitude": -75.56, "timezone": "UTC"}

SETTINGS = Settings(level_codes=STATUS_CODES)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def trusted_of(spark: SparkSession, folder: str) -> DataFrame:
    return build_trusted(weather_days(spark, folder), incident_extract(spark, folder), SETTINGS)


def landed(spark: SparkSession, folder: str, name: str) -> Layout:
    """Both raw inputs written as files: weather documents and an incident extract."""
    layout = Layout(new_folder(spark, name))
    land_documents(
        pack_documents(weather_days(spark, folder), place=PLACE), layout.raw_weather
    )
    land_extract(incident_extract(spark, folder), layout.raw_incidents)
    return layout


def trusted_from_raw(spark: SparkSession, layout: Layout) -> DataFrame:
    days = unpack_days(read_weather_documents(spark, layout.raw_weather))
    return build_trusted(days, read_extract(spark, layout.raw_incidents), SETTINGS)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def entry_query(spark: SparkSession, folder: str) -> DataFrame:
    stats = summary.level_stats(trusted_from_raw(spark, landed(spark, folder, "entry")))
    return rounded(stats, "avg_incidents", "avg_temp", "avg_precip")


# Raw -> trusted.


@query
def unpack_parallel_arrays(spark: SparkSession, folder: str) -> DataFrame:
    path = Layout(new_folder(spark, "documents")).raw_weather
    land_documents(pack_documents(weather_days(spark, folder), place=PLACE), path)
    return unpack_days(read_weather_documents(spark, path))


@query
def etl_trusted(spark: SparkSession, folder: str) -> DataFrame:
    return trusted_from_raw(spark, landed(spark, folder, "trusted"))


@query
def raw_level_stats(spark: SparkSession, folder: str) -> DataFrame:
    return entry_query(spark, folder)


@query
def skew_sliced_join(spark: SparkSession, folder: str) -> DataFrame:
    """The join beyond the broadcast limit, with so few rows to a task that days are cut."""
    incidents = typed_incidents(incident_extract(spark, folder), SETTINGS)
    joined = sliced_join(incidents, weather_days(spark, folder), ["date"], rows_per_task=4)
    return joined.select(
        "date", "id", "city", VALUE, "max_temp", "precipitation", LEVEL
    )


@query
def hot_keys_join(spark: SparkSession, folder: str) -> DataFrame:
    """Three keys with all rows of one side, first of the facts and then of the other side."""
    items = star_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    totals = items.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("total"))
    key, rows = ["l_returnflag"], 5000
    hot = {
        "facts": sliced_join(items, totals, key, rows),
        "other": sliced_join(totals, items, key, rows),
    }
    parts = [
        joined.select(
            F.lit(side).alias("hot_side"),
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            F.round(F.col("l_quantity") / F.col("total"), 9).alias("share"),
        )
        for side, joined in hot.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def stage_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """As the run from the raw to the trusted zone counts them."""
    layout = landed(spark, folder, "counts")
    write_trusted(spark, layout, SETTINGS)
    return read_table(spark, layout.stage_counts, STAGE_COUNTS)


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "extract")
    land_extract(incident_extract(spark, folder), path)
    return read_extract(spark, path)


@query
def csv_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes, separators and line breaks."""
    path = new_folder(spark, "texts")
    turns = star_table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("string").alias("turn"),
        "role",
        F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"),
    )
    land_extract(turns, path)
    back = read_extract(spark, path, turns.schema, multiline=True)
    return back.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query
def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of a label with unknown values and NULLs."""
    label = F.when(F.col("event_type") != "error", F.col("event_type"))
    return star_table(spark, folder, "events").select(
        "event_id", ordinal_code(label, {"click": 1, "view": 2}, 3).alias("code")
    )


@query
def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Text of whole numbers, decimals, dates and words to int and date."""
    orders = star_table(spark, folder, "orders")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.col("o_custkey").cast("string"), F.lit(".75")))
        .otherwise(F.col("o_orderpriority"))
    )
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string"))
    return orders.select(
        "o_orderkey",
        casting.lenient_int(text).alias("as_int"),
        casting.lenient_date(F.coalesce(day, F.lit("nope"))).alias("as_date"),
    )


@query
def rename_select(spark: SparkSession, folder: str) -> DataFrame:
    return (
        trusted_of(spark, folder)
        .withColumnRenamed(VALUE, "label")
        .withColumn("level_text", F.col(LEVEL).cast("string"))
        .drop("city")
        .select("id", "label", "level_text", LEVEL, "date")
    )


# Descriptive statistics.


@query
def global_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = summary.global_stats(trusted_of(spark, folder))
    return rounded(stats, "avg_incidents", "std_incidents", "avg_temp", "avg_precip", "min_temp", "max_temp")


@query
def level_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = summary.level_stats(trusted_of(spark, folder))
    return rounded(stats, "avg_incidents", "avg_temp", "avg_precip")


@query
def correlations(spark: SparkSession, folder: str) -> DataFrame:
    stats = summary.correlations(trusted_of(spark, folder))
    return rounded(stats, "temp_corr", "precip_corr", "congestion_corr")


@query
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = summary.correlation_matrix(trusted_of(spark, folder), [VALUE, *SETTINGS.features])
    return rounded(matrix, "r")


@query
def constant_correlation(spark: SparkSession, folder: str) -> DataFrame:
    """A variable without variance and one with gaps."""
    labels = star_table(spark, folder, "labels").select(
        F.when(F.col("toxic") == 0, F.col("quality").cast("double")).alias("quality"),
        F.col("doc_id").cast("double").alias("doc"),
        F.lit(1.0).alias("constant"),
    )
    return rounded(summary.correlation_matrix(labels, ["quality", "doc", "constant"]), "r")


@query
def temp_view_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over a temporary view of the trusted rows."""
    trusted_of(spark, folder).createOrReplaceTempView("rainlane_incidents")
    return spark.sql(
        "SELECT city, congestion_level_num, COUNT(*) AS days_count, "
        "CAST(SUM(reported_incidents) AS BIGINT) AS total_incidents, "
        "MIN(date) AS first_day, MAX(date) AS last_day "
        "FROM rainlane_incidents GROUP BY city, congestion_level_num"
    )


# Chart datasets.


@query
def equal_width_bins(spark: SparkSession, folder: str) -> DataFrame:
    events = star_table(spark, folder, "events").select("event_id", "value")
    return charts.with_bin(events, "value", SETTINGS.bins, "bin").select("event_id", "bin")


@query
def binned_mean_temp(spark: SparkSession, folder: str) -> DataFrame:
    bars = charts.binned_mean(trusted_of(spark, folder), "max_temp", SETTINGS.bins, VALUE, LEVEL)
    return rounded(bars, f"mean_{VALUE}", "lower", "upper")


@query
def binned_mean_precip(spark: SparkSession, folder: str) -> DataFrame:
    bars = charts.binned_mean(trusted_of(spark, folder), "precipitation", SETTINGS.bins, VALUE, LEVEL)
    return rounded(bars, f"mean_{VALUE}", "lower", "upper")


@query
def level_totals(spark: SparkSession, folder: str) -> DataFrame:
    return charts.level_totals(trusted_of(spark, folder), VALUE, LEVEL)


@query
def chart_bars_one_pass(spark: SparkSession, folder: str) -> DataFrame:
    """The three bar charts from one cube."""
    data = analyse(stage(trusted_of(spark, folder), "trusted"), SETTINGS).datasets
    binned = [
        data[kind].select(
            F.lit(kind).alias("chart"),
            F.col("bin").cast("string").alias("x"),
            F.col(LEVEL).alias("hue"),
            F.round(f"mean_{VALUE}", 6).alias("y"),
        )
        for kind in ("temp_incidents_bar", "precip_incidents_bar")
    ]
    totals = data["congestion_incidents_bar"].select(
        F.lit("congestion_incidents_bar").alias("chart"),
        F.col("congestion_level_str").alias("x"),
        F.lit(None).cast("int").alias("hue"),
        F.col("total_incidents").cast("double").alias("y"),
    )
    return binned[0].unionByName(binned[1]).unionByName(totals)


@query
def statistics_from_cube(spark: SparkSession, folder: str) -> DataFrame:
    """The descriptive tables as the daily run makes them, as names and values."""
    tables = analyse(stage(trusted_of(spark, folder), "trusted"), SETTINGS).tables
    levels = tables["congestion_stats"].select(
        F.concat(F.lit("level_"), F.col(LEVEL).cast("string")).alias("name"),
        F.round("avg_precip", 6).alias("value"),
        "days_count",
    )
    overall = tables["global_stats"].select(
        F.lit("overall").alias("name"),
        F.round("std_incidents", 6).alias("value"),
        F.lit(None).cast("bigint").alias("days_count"),
    )
    correlation = tables["correlations"].select(
        F.lit("temp_corr").alias("name"),
        F.round("temp_corr", 6).alias("value"),
        F.lit(None).cast("bigint").alias("days_count"),
    )
    return levels.unionByName(overall).unionByName(correlation)


@query
def artifact_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Size of a written extract, from the listing of its files."""
    path = new_folder(spark, "artifacts")
    rows = star_table(spark, folder, "orders").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")
    )
    rows.write.text(path)
    return artifact_files(spark, path, "*.txt").agg(
        F.round(F.sum("file_size_kb"), 6).alias("total_kb")
    )


@query
def artifact_fields(spark: SparkSession, folder: str) -> DataFrame:
    stamp = naming.run_stamp(F.col("ts"))
    return star_table(spark, folder, "events").select(
        "event_id",
        naming.artifact_id(F.col("event_type"), stamp).alias("artifact_id"),
        naming.artifact_location("s3://bucket/refined", F.col("event_type")).alias("location"),
        naming.kilobytes(F.col("user_id")).alias("size_kb"),
    )


@query
def chart_metadata_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of the charts of the trusted rows, sized by their written datasets."""
    base = new_folder(spark, "charts")
    for kind, data in chart_datasets(stage(trusted_of(spark, folder), "trusted"), SETTINGS).items():
        data.write.json(f"{base}/{CHARTS[kind]['artifact']}")
    stamp = naming.run_stamp(F.lit("2025-03-01 12:30:05").cast("timestamp_ntz"))
    rows = chart_metadata(chart_descriptions(spark), run_files(spark, base), "s3://bucket", stamp)
    return rows.select(
        "visualization_id",
        "s3_location",
        (F.col("file_size_kb") > 0).alias("has_size"),
        F.col("dimensions.width").alias("width"),
        F.col("dimensions.height").alias("height"),
        F.col("related_data.temperature").alias("temperature"),
        F.col("related_data.correlation").alias("correlation"),
        F.col("parameters")["plot_type"].alias("plot_type"),
        F.col("parameters")["bins"].alias("bins"),
    )


# Sinks, tables and serving.


def nested_customers(spark: SparkSession, folder: str) -> DataFrame:
    return star_table(spark, folder, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_nationkey").alias("width"), (F.col("c_nationkey") * 2).alias("height")
        ).alias("dimensions"),
        F.create_map(
            F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name")
        ).alias("parameters"),
    )


@query
def parquet_struct_map(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "nested")
    rows = nested_customers(spark, folder)
    for _ in range(2):
        overwrite_table(rows, path)
    return read_table(spark, path, rows.schema).select(
        "c_custkey",
        F.col("dimensions.height").alias("height"),
        F.col("parameters")["segment"].alias("segment"),
        F.col("parameters")["bins"].alias("bins"),
    )


@query
def append_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends keep both copies."""
    path = new_folder(spark, "appended")
    rows = nested_customers(spark, folder)
    for _ in range(2):
        append_table(rows, path)
    return (
        read_table(spark, path, rows.schema)
        .groupBy(F.col("parameters")["segment"].alias("segment"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("dimensions.width").alias("width"))
    )


@query
def external_table_subset(spark: SparkSession, folder: str) -> DataFrame:
    """A table declared with some of the columns its files hold, in another order."""
    path = new_folder(spark, "external")
    rows = star_table(spark, folder, "orders")
    overwrite_table(rows, path)
    declared = struct(o_orderstatus=TEXT, o_custkey=LONG, o_orderkey=LONG)
    return register_table(spark, "rainlane_orders_subset", path, declared)


@query
def named_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptive tables written, registered and read back by dataset name."""
    layout = Layout(new_folder(spark, "refined"))
    write_descriptive(descriptive(stage(trusted_of(spark, folder), "trusted"), SETTINGS), layout)
    names = ["congestion-stats", "global-stats", "correlations"]
    register_datasets(spark, layout, "rainlane_checks", names)
    levels = serve(spark, "/congestion-stats", "rainlane_checks").select(
        F.concat(F.lit("level_"), F.col(LEVEL).cast("string")).alias("name"),
        F.round("avg_incidents", 6).alias("value"),
    )
    overall = serve(spark, "global-stats", "rainlane_checks").select(
        F.lit("overall").alias("name"), F.round("avg_incidents", 6).alias("value")
    )
    correlation = serve(spark, "correlations", "rainlane_checks").select(
        F.lit("precip_corr").alias("name"), F.round("precip_corr", 6).alias("value")
    )
    return levels.unionByName(overall).unionByName(correlation)


@query
def json_records(spark: SparkSession, folder: str) -> DataFrame:
    orders = star_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return as_records(orders)


@query
def nested_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of structs, maps and arrays."""
    rows = nested_customers(spark, folder).withColumn(
        "tags", F.array(F.col("c_custkey"), F.lit(None).cast("bigint"))
    )
    return as_records(rows)


# Models.


@query
def features_array(spark: SparkSession, folder: str) -> DataFrame:
    rows = trees.assembler(SETTINGS.features).transform(trusted_of(spark, folder))
    values = vector_to_array("features")
    return rows.select(
        "id", *(F.round(values[i], 6).alias(f"f{i}") for i in range(len(SETTINGS.features)))
    )


@query
def round_to_int(spark: SparkSession, folder: str) -> DataFrame:
    return star_table(spark, folder, "orders").select(
        "o_orderkey",
        casting.rounded_int("o_totalprice").alias("price"),
        casting.rounded_int(F.pmod("o_custkey", F.lit(1_000_000)) / -2).alias("negative_half"),
    )


@query
def stable_split(spark: SparkSession, folder: str) -> DataFrame:
    training = splitting.in_training(F.col("o_orderkey"))
    return (
        star_table(spark, folder, "orders")
        .select(F.when(training, "train").otherwise("test").alias("part"), "o_custkey")
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_custkey").alias("key_sum"))
    )


@query
def random_split(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of the seeded split: disjoint, complete, about 70 to 30."""
    orders = star_table(spark, folder, "orders").select("o_orderkey")
    train, test = splitting.random_parts(orders, SETTINGS.train_share, SETTINGS.seed)
    in_train, in_test = F.lit(1).alias("train"), F.lit(0).alias("train")
    per_key = (
        train.select("o_orderkey", in_train)
        .unionByName(test.select("o_orderkey", in_test))
        .groupBy("o_orderkey")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("train").alias("train"))
    )
    return per_key.agg(
        F.sum("copies").alias("n_rows"),
        F.count_if(F.col("copies") > 1).alias("in_both"),
        F.abs(F.sum("train") / F.sum("copies") - 0.7).between(0.0, 0.05).alias("about_seventy"),
    )


def fixed_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two fixed predictors in place of fitted models, whose values SQL can state too."""
    return trusted_of(spark, folder).select(
        F.col(VALUE).alias(trees.LABEL),
        (F.lit(100.0) + F.lit(10.0) * F.col(LEVEL)).alias("rf_prediction"),
        (F.lit(240.0) + F.lit(0.5) * F.col("max_temp")).alias("gbt_prediction"),
    )


PREDICTIONS = {MODEL_RF: "rf_prediction", MODEL_GBT: "gbt_prediction"}


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.regression_metrics(fixed_predictions(spark, folder), trees.LABEL, PREDICTIONS)
    return rounded(rows, "rmse", "mae")


@query
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.best_model(fixed_predictions(spark, folder), trees.LABEL, PREDICTIONS)


@query
def eval_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.evaluation_report(fixed_predictions(spark, folder), trees.LABEL, PREDICTIONS)
    return rounded(rows, "rmse", "mae").drop("evaluation_timestamp")


@query
def report_time(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a report have one time, the same for all."""
    rows = metrics.evaluation_report(fixed_predictions(spark, folder), trees.LABEL, PREDICTIONS)
    time = F.col("evaluation_timestamp")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(time).alias("n_times"),
        F.count_if(time.isNull()).alias("n_missing"),
    )


@query
def scenario_spine(spark: SparkSession, folder: str) -> DataFrame:
    """A scenario row per customer, spread over sixty days."""
    key = F.col("c_custkey")
    rows = scenario(
        star_table(spark, folder, "customer"),
        offset=F.pmod(key, F.lit(60)),
        row_id=key + 1,
        max_temp=F.col("c_acctbal"),
        precipitation=F.col("c_acctbal"),
        level=F.col("c_nationkey"),
        city=F.col("c_mktsegment"),
    )
    return rows.select("date", "id", "city")


def rows_to_score(spark: SparkSession, folder: str) -> DataFrame:
    """The trusted rows in the form of a scenario."""
    return trusted_of(spark, folder).select(
        naming.iso_date(F.col("date")).alias("date"),
        F.col("id").cast("bigint").alias("id"),
        "city",
        "max_temp",
        "precipitation",
        LEVEL,
    )


def searched(spark: SparkSession, rows: DataFrame, regressor, grid, settings: Settings) -> DataFrame:
    """Mean RMSE of every setting of ``grid`` over the folds of ``rows``."""
    trees.prepare_checkpoints(spark)
    search = trees.cross_validated(regressor, grid, settings, fold_column="fold")
    return trees.search_results(spark, search.fit(rows), grid)


def rows_to_search(spark: SparkSession, folder: str) -> DataFrame:
    return model_rows(stage(trusted_of(spark, folder), "training"), SETTINGS)


def rf_cv(spark: SparkSession, folder: str) -> DataFrame:
    """The full search: 27 settings, 5 folds."""
    return searched(spark, rows_to_search(spark, folder), trees.forest(SETTINGS), SETTINGS.grids.rf, SETTINGS)


def gbt_cv(spark: SparkSession, folder: str) -> DataFrame:
    """The full search: 12 settings, 5 folds."""
    return searched(spark, rows_to_search(spark, folder), trees.boosted(SETTINGS), SETTINGS.grids.gbt, SETTINGS)


def holdout_report(spark: SparkSession, folder: str) -> DataFrame:
    """Both full searches, fit and evaluate both models."""
    return train_eval(stage(trusted_of(spark, folder), "training"), SETTINGS).report.drop(
        "evaluation_timestamp"
    )


#: Searches on all features, which take longer than a check has; see the README for their time.
FULL_SEARCHES: dict[str, Query] = {"rf_cv": rf_cv, "gbt_cv": gbt_cv, "holdout_report": holdout_report}


def fitted(spark: SparkSession, folder: str, regressor):
    rows = trees.labelled(stage(trusted_of(spark, folder), "training"), SETTINGS)
    return trees.regression_chain(regressor, SETTINGS).fit(rows)


@query
def score_rf(spark: SparkSession, folder: str) -> DataFrame:
    model = fitted(spark, folder, trees.forest(SETTINGS, numTrees=10, maxDepth=3))
    return trees.score(model, rows_to_score(spark, folder))


@query
def score_gbt(spark: SparkSession, folder: str) -> DataFrame:
    model = fitted(spark, folder, trees.boosted(SETTINGS, maxIter=3, maxDepth=3))
    return trees.score(model, rows_to_score(spark, folder))


# On the level alone, one tree that is deep enough predicts the mean of each level,
# and one of depth 0 the mean of all rows; SQL can state both.
LEVELS_ONLY = replace(
    SETTINGS,
    features=(LEVEL,),
    grids=TreeGrids(
        rf={"numTrees": (1,), "maxDepth": (2,), "bootstrap": (False,)},
        gbt={"maxIter": (1,), "maxDepth": (0,)},
        folds=2,
    ),
)


def fitted_to_levels(spark: SparkSession, folder: str, regressor):
    rows = trees.labelled(stage(trusted_of(spark, folder), "training"), LEVELS_ONLY)
    return trees.regression_chain(regressor, LEVELS_ONLY).fit(rows)


# The same feature under the full grids, and folds that SQL can state. Any tree that is deep
# enough predicts the mean of each level of the training rows if it is grown on all of them.
LEVEL_SEARCH = replace(SETTINGS, features=(LEVEL,))


def level_folds(spark: SparkSession, folder: str) -> DataFrame:
    rows = trusted_of(spark, folder).withColumn("fold", F.pmod(F.col("id").cast("bigint"), F.lit(5)).cast("int"))
    return trees.labelled(rows, LEVEL_SEARCH, "fold")


def searched_on_levels(spark: SparkSession, folder: str, regressor, grid) -> DataFrame:
    """All rows take part, those that agree in level, label and fold as one with a weight."""
    rows = trees.counted(level_folds(spark, folder), max(grid.get("minInstancesPerNode", (1,))))
    rows = trees.fit_table(rows, LEVEL_SEARCH, "level-folds")
    found = searched(spark, rows, regressor.setWeightCol(trees.WEIGHT), grid, LEVEL_SEARCH)
    return rounded(found, "avg_rmse")


@query
def rf_cv_levels(spark: SparkSession, folder: str) -> DataFrame:
    forest = trees.forest(LEVEL_SEARCH, bootstrap=False)
    return searched_on_levels(spark, folder, forest, LEVEL_SEARCH.grids.rf)


@query
def gbt_cv_levels(spark: SparkSession, folder: str) -> DataFrame:
    return searched_on_levels(spark, folder, trees.boosted(LEVEL_SEARCH), LEVEL_SEARCH.grids.gbt)


@query
def boosting_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Trees of one split, of which one is too few for three levels: each round counts."""
    grid = {"maxIter": (1, 2), "maxDepth": (1,), "stepSize": (0.1,)}
    return searched_on_levels(spark, folder, trees.boosted(LEVEL_SEARCH), grid)


@query
def score_rf_levels(spark: SparkSession, folder: str) -> DataFrame:
    forest = trees.forest(LEVELS_ONLY, numTrees=1, maxDepth=2, bootstrap=False)
    return trees.score(
        fitted_to_levels(spark, folder, forest), rows_to_score(spark, folder)
    )


@query
def score_gbt_levels(spark: SparkSession, folder: str) -> DataFrame:
    boosted = trees.boosted(LEVELS_ONLY, maxIter=1, maxDepth=2)
    return trees.score(
        fitted_to_levels(spark, folder, boosted), rows_to_score(spark, folder)
    )


@query
def stored_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Both models written, read again and applied to all days."""
    layout = Layout(new_folder(spark, "store"), run="one")
    grids = LEVELS_ONLY.grids
    forest = fitted_to_levels(spark, folder, trees.forest(LEVELS_ONLY, numTrees=1, maxDepth=2, bootstrap=False))
    boosted = fitted_to_levels(spark, folder, trees.boosted(LEVELS_ONLY, maxIter=1, maxDepth=2))
    report = metrics.evaluation_report(fixed_predictions(spark, folder), trees.LABEL, PREDICTIONS)
    models = {MODEL_RF: (forest, grids.rf), MODEL_GBT: (boosted, grids.gbt)}
    save_models(layout, models, report, datetime.now(timezone.utc))
    stored = load_models(spark, layout)
    scored = scored_days(trusted_of(spark, folder), stored[MODEL_RF], stored[MODEL_GBT], LEVELS_ONLY)
    return scored.select("id", "rf_incidents", "gbt_incidents")


@query
def holdout_report_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Search, fit and report on the stable parts."""
    rows = stage(trusted_of(spark, folder), "training")
    training = splitting.in_training(F.col("id"))
    train, holdout = (
        trees.labelled(part, LEVELS_ONLY) for part in (rows.where(training), rows.where(~training))
    )
    report = fit_and_report(train, holdout, LEVELS_ONLY).report
    return rounded(report, "rmse", "mae").drop("evaluation_timestamp")


@query
def holdout_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Every row scored by both models, counted by label and level of agreement."""
    rows = trees.labelled(stage(trusted_of(spark, folder), "training"), SETTINGS)
    rf = trees.regression_chain(trees.forest(SETTINGS, numTrees=5, maxDepth=2), SETTINGS).fit(rows)
    gbt = trees.regression_chain(trees.boosted(SETTINGS, maxIter=2, maxDepth=2), SETTINGS).fit(rows)
    scored = holdout_scores(rf, gbt, rows)
    both = F.col("rf_prediction").isNotNull() & F.col("gbt_prediction").isNotNull()
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(both).alias("scored_by_both"),
        F.sum(F.col(trees.LABEL).cast("bigint")).alias("label_sum"),
    )


def measures(rows: DataFrame, dataset: str, key: Column, *columns: str) -> DataFrame:
    """One row per value: dataset, item, measure, value."""
    values = [F.struct(F.lit(c).alias("measure"), F.round(F.col(c).cast("double"), 6).alias("value")) for c in columns]
    return rows.select(F.lit(dataset).alias("dataset"), key.cast("string").alias("item"), F.inline(F.array(*values)))


@query
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run without models on the landed tables: what the served tables say."""
    layout = landed(spark, folder, "daily")
    run_daily(spark, layout, SETTINGS, database="rainlane_daily", with_models=False)
    tables = {name: serve(spark, name, "rainlane_daily") for name in DESCRIPTIVE}
    whole = F.lit("all")
    parts = [
        measures(tables["global-stats"], "global-stats", whole, *tables["global-stats"].columns),
        measures(tables["correlations"], "correlations", whole, *tables["correlations"].columns),
        measures(tables["congestion-stats"], "congestion-stats", F.col(LEVEL), "days_count", "avg_incidents", "avg_temp", "avg_precip"),
        measures(tables["visualizations"].groupBy("visualization_type").agg(F.count(F.lit(1)).alias("charts")), "visualizations", F.col("visualization_type"), "charts"),
        measures(read_table(spark, layout.stage_counts, STAGE_COUNTS), "stage-counts", F.col("stage"), "n_rows"),
    ]
    return reduce(DataFrame.unionByName, parts)


# Arrivals.


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """An extract taken in as a stream; a second run finds nothing new."""
    layout = Layout(new_folder(spark, "arrivals"))
    land_extract(incident_extract(spark, folder), layout.raw_incidents)
    for _ in range(2):
        ingest_incidents(spark, layout, SETTINGS).awaitTermination()
    return spark.read.parquet(layout.landed_incidents).select(
        "date", "id", "city", VALUE, LEVEL
    )


@query
def incremental_trusted(spark: SparkSession, folder: str) -> DataFrame:
    """Part of an export, all of it again in its place, and weather that comes in two parts;
    a refresh after each."""
    layout = Layout(new_folder(spark, "refresh"))
    extract, days = incident_extract(spark, folder), weather_days(spark, folder)
    early = F.year("date") < 1995
    land_extract(extract.where(F.col("congestion_level") == "F"), layout.raw_incidents)
    land_documents(pack_documents(days.where(early), place=PLACE), layout.raw_weather)
    catch_up(spark, layout, SETTINGS)
    land_extract(extract, layout.raw_incidents)
    land_documents(pack_documents(days.where(~early), place=PLACE), layout.raw_weather, "append")
    return catch_up(spark, layout, SETTINGS)


@query
def set_aside_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Each weather document arrives cut off as well; what can be read is taken in, and the rest
    is put aside and counted."""
    layout, settings = landed(spark, folder, "aside"), replace(SETTINGS, corrupt="set_aside")
    documents = spark.read.text(layout.raw_weather, wholetext=True)
    cut = stage(documents.select(F.expr("substr(value, 1, length(value) div 2)").alias("value")), "cut")
    cut.write.mode("append").option("maxRecordsPerFile", 1).text(layout.raw_weather)
    trusted = catch_up(spark, layout, settings).agg(F.lit("trusted").alias("stage"), F.count(F.lit(1)).alias("n_rows"))
    counts = arrival_counts(spark, layout, listings_of(spark, layout))
    return counts.where("stage not like '%files'").unionByName(trusted)


@query
def compacted_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """An export that came three times is landed once in the end."""
    layout, settings = Layout(new_folder(spark, "compacted")), replace(SETTINGS, dead_share=0.0)
    for _ in range(3):
        land_extract(incident_extract(spark, folder), layout.raw_incidents)
        catch_up(spark, layout, settings)
    return spark.read.parquet(layout.landed_incidents).select("date", "id", "city", VALUE, LEVEL)
