import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rainlane.catalog.datasets import serve
from rainlane.fixed_values import DATASETS
from rainlane.learning import trees
from rainlane.operators.scenario import default_scenario
from rainlane.operators.splitting import in_training, random_parts, stable_parts
from rainlane.operators.unpack import pack_documents
from rainlane.plans.daily import run_daily, run_on_arrival
from rainlane.schemas import (
    INCIDENT_EXTRACT, PREDICTIONS, SCENARIO, TRUSTED, WEATHER_DAYS,
)
from rainlane.settings import Layout, Settings, TreeGrids
from rainlane.sinks.raw import land_documents, land_extract
from rainlane.sources.tables import read_table
from rainlane.staging import stage

SMALL = replace(
    Settings(),
    grids=TreeGrids(
        rf={"numTrees": (3, 5), "maxDepth": (3,), "minInstancesPerNode": (1,)},
        gbt={"maxIter": (2,), "maxDepth": (2,), "stepSize": (0.1,)},
        folds=2,
    ),
)


@pytest.fixture(scope="module")
def trusted(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        level = rng.randint(1, 3)
        rows.append(
            (date(2022, 1, 1) + timedelta(days=i), str(i), "M", 10 * level, rng.uniform(18, 30), rng.uniform(0, 9), level)
        )
    return stage(spark.createDataFrame(rows, TRUSTED), "test-trusted")


def test_default_grids_are_full(spark):
    settings = Settings()
    assert len(trees.param_grid(trees.forest(settings), settings.grids.rf)) == 27
    assert len(trees.param_grid(trees.boosted(settings), settings.grids.gbt)) == 12
    search = trees.cross_validated(trees.forest(settings), settings.grids.rf, settings)
    assert (search.getNumFolds(), search.getSeed(), search.getParallelism()) == (5, 42, 4)
    assert trees.forest(settings).getSeed() == trees.boosted(settings).getSeed() == 42


def test_search_results_follow_the_grid(spark, trusted):
    rows = trees.labelled(trusted, SMALL)
    assert rows.columns == ["label", *SMALL.features]
    fitted = trees.cross_validated(trees.forest(SMALL), SMALL.grids.rf, SMALL).fit(rows)
    results = trees.search_results(spark, fitted, SMALL.grids.rf).collect()
    assert [(r.numTrees, r.maxDepth) for r in results] == [(3.0, 3.0), (5.0, 3.0)]
    assert all(r.avg_rmse >= 0 for r in results)


def test_a_forest_learns_levels(spark, trusted):
    rows = trees.labelled(trusted, SMALL)
    model = trees.regression_chain(trees.forest(SMALL, numTrees=20, maxDepth=4), SMALL).fit(rows)
    levels = spark.createDataFrame(
        [("2025-03-01", n, "M", 24.0, 4.0, n) for n in range(1, 7)], SCENARIO
    )
    scored = trees.score(model, levels)
    assert [(f.name, f.dataType) for f in scored.schema] == [(f.name, f.dataType) for f in PREDICTIONS]
    got = {r.congestion_level_num: r.predicted_incidents for r in scored.collect()}
    assert got[1] < got[2] < got[3]
    assert got[3] == got[4] == got[5] == got[6]


def test_missing_features_are_refused_unless_skipped(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        trees.assembler(("a", "b")).transform(df).collect()
    assert trees.assembler(("a", "b"), "skip").transform(df).count() == 0


def test_random_parts_are_disjoint_and_complete(trusted):
    train, test = random_parts(trusted, 0.7, 42)
    train_ids, test_ids = ({r.id for r in part.select("id").collect()} for part in (train, test))
    assert not train_ids & test_ids and len(train_ids | test_ids) == 300
    assert 0.6 < len(train_ids) / 300 < 0.8
    assert {r.id for r in random_parts(trusted, 0.7, 42)[0].collect()} == train_ids


def test_stable_parts_do_not_depend_on_the_partitioning(trusted):
    def ids(df):
        return {r.id for r in df.select("id").collect()}

    train, test = stable_parts(trusted, "id", 0.7, 42)
    again, _ = stable_parts(trusted.repartition(5), "id", 0.7, 42)
    assert ids(train) == ids(again)
    assert not ids(train) & ids(test) and len(ids(train) | ids(test)) == 300
    assert 0.6 < len(ids(train)) / 300 < 0.8


def test_rows_without_key_are_in_one_part(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "id string")
    train, test = stable_parts(df, "id", 0.5, 1)
    assert train.count() + test.count() == 3


def test_split_by_tenths(spark):
    rows = spark.range(100).select(in_training(F.col("id")).alias("t"))
    assert rows.where("t").count() == 70


def test_default_scenario(spark):
    rows = default_scenario(spark, seed=42)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in SCENARIO]
    got = sorted(rows.collect(), key=lambda r: r.id)
    assert [r.id for r in got] == list(range(1, 61))
    assert [r.date for r in got] == [(date(2025, 3, 1) + timedelta(days=i)).isoformat() for i in range(60)]
    assert {r.city for r in got} == {"Medellín"}
    assert {r.congestion_level_num for r in got} <= set(range(1, 7))
    assert all(0 <= r.precipitation <= 5 and r.precipitation == round(r.precipitation, 2) for r in got)
    assert all(r.max_temp == round(r.max_temp, 1) and 20 < r.max_temp < 36 for r in got)
    assert sorted(default_scenario(spark, seed=42).collect(), key=lambda r: r.id) == got
    assert sorted(default_scenario(spark, seed=43).collect(), key=lambda r: r.id) != got


def test_whole_run_serves_eight_datasets(spark, tmp_path):
    rng = random.Random(9)
    days = [(date(2022, 1, 1) + timedelta(days=i), round(rng.uniform(18, 30), 1), round(rng.uniform(0, 9), 1)) for i in range(120)]
    layout = Layout(str(tmp_path))
    land_documents(pack_documents(spark.createDataFrame(days, WEATHER_DAYS)), layout.raw_weather)
    incidents = [
        (str(i), "M", str(rng.randint(0, 20)), rng.choice(["Bajo", "Medio", "Alto"]), d.isoformat())
        for i, (d, _, _) in enumerate(days)
    ]
    land_extract(spark.createDataFrame(incidents, INCIDENT_EXTRACT), layout.raw_incidents)
    run_daily(spark, layout, SMALL, database="rainlane_run")
    assert read_table(spark, layout.trusted, TRUSTED).count() == 120

    def statistics():
        return [v for r in serve(spark, "congestion-stats", "rainlane_run").collect() for v in r]

    from_full_run = statistics()
    assert run_on_arrival(spark, layout, SMALL, database="rainlane_run")
    assert not run_on_arrival(spark, layout, SMALL, database="rainlane_run")
    assert statistics() == pytest.approx(from_full_run)
    counts = {name: serve(spark, name, "rainlane_run").count() for name in DATASETS}
    assert counts == {
        "congestion-stats": 3, "global-stats": 1, "correlations": 1, "visualizations": 8,
        "test-data": 60, "model-evaluation": 3, "predictions-gbt": 60, "predictions-rf": 60,
    }
    charts = serve(spark, "visualizations", "rainlane_run").collect()
    assert all(r.file_size_kb > 0 for r in charts)
    report = {r.model: r for r in serve(spark, "model-evaluation", "rainlane_run").collect()}
    best = report["Best Model"]
    assert best.rmse is None and best.best_model in report
    assert report[best.best_model].rmse == min(r.rmse for m, r in report.items() if m != "Best Model")
    assert len({r.evaluation_timestamp for r in report.values()}) == 1
