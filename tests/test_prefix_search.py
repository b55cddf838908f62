"""One fit for all sizes of an ensemble gives what a fit for each size gives."""

import random
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel

from rainlane.learning import prefixes, trees
from rainlane.settings import Settings, TreeGrids
from rainlane.staging import stage

SETTINGS = replace(Settings(), grids=TreeGrids(folds=3))
GRIDS = {
    "gbt": {"maxIter": (2, 5, 4), "maxDepth": (1, 2), "stepSize": (0.1, 0.5)},
    "rf": {"numTrees": (1, 4, 6), "maxDepth": (2, 3)},
}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    made = []
    for i in range(240):
        level, temp, rain = rng.randint(1, 3), rng.uniform(18, 30), rng.uniform(0, 9)
        made.append((10 * level + int(temp) + rng.randint(0, 3), temp, rain, level, i % 3))
    frame = spark.createDataFrame(made, "label int, max_temp double, precipitation double, congestion_level_num int, fold int")
    return stage(frame.coalesce(1), "prefix-rows")


def regressor(kind, **params):
    # Without a draw of rows each forest's trees are the same ones.
    if kind == "gbt":
        return trees.boosted(SETTINGS, **params)
    return trees.forest(SETTINGS, bootstrap=False, featureSubsetStrategy="all", **params)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_metrics_equal_those_of_separate_fits(spark, rows, kind, monkeypatch):
    fits = []
    fit = Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    search = trees.cross_validated(regressor(kind), GRIDS[kind], SETTINGS, "fold")
    found = search.fit(rows)
    points = 12 if kind == "gbt" else 6
    assert len(fits) == 3 * points // 3 + 1
    plain = search.setEstimator(Pipeline(stages=search.getEstimator().getStages())).fit(rows)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    assert len(fits) == 3 * points // 3 + 1 + 3 * points + 1
    assert isinstance(found.bestModel, PipelineModel)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_first_trees(spark, rows, kind):
    size = {"gbt": "maxIter", "rf": "numTrees"}[kind]
    whole, part = (
        trees.regression_chain(regressor(kind, **{size: n}), SETTINGS).fit(rows) for n in (6, 2)
    )
    cut = prefixes.first_trees(whole.stages[-1], 2)
    assert len(cut.trees) == 2 and len(whole.stages[-1].trees) == 6
    data = whole.stages[0].transform(rows)
    assert [r.prediction for r in cut.transform(data).collect()] == pytest.approx(
        [r.prediction for r in part.transform(rows).collect()]
    )


def test_a_failing_fit_is_raised(spark, rows):
    bad = trees.cross_validated(trees.boosted(SETTINGS), {"maxIter": (1, 2), "maxDepth": (99,)}, SETTINGS, "fold")
    with pytest.raises(Exception, match="(?i)depth"):
        bad.fit(rows)


def fold_levels(spark):
    """Few rows that often repeat, some levels rare; a row per (label, level, fold) on its own too."""
    rng = random.Random(7)
    made = [(rng.choice((3, 4, 9, 20)) + 5 * level, level, rng.randint(0, 2)) for level in (1, 2, 2, 3, 3, 3) for _ in range(80)]
    made += [(50, 4, fold) for fold in (0, 1, 1, 2)] + [(70, 5, fold) for fold in (0, 1, 2)]
    return spark.createDataFrame(made, "label int, congestion_level_num int, fold int").repartition(4)


LEVELS = replace(SETTINGS, features=("congestion_level_num",))
LEVEL_GRIDS = {
    "gbt": {"maxIter": (3, 6), "maxDepth": (1, 3, 6), "stepSize": (0.1,)},
    "rf": {"numTrees": (1, 3), "maxDepth": (1, 4, 9), "minInstancesPerNode": (1, 3, 4, 6)},
}


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_equal_rows_counted_give_the_metrics_of_all_rows(spark, kind):
    grid, rows = LEVEL_GRIDS[kind], fold_levels(spark)
    small = trees.fit_table(trees.counted(rows, max(grid.get("minInstancesPerNode", (1,)))), LEVELS, "counted")
    assert small.rdd.getNumPartitions() == 1
    plain = trees.cross_validated(regressor(kind), grid, LEVELS, "fold")
    whole = plain.setEstimator(Pipeline(stages=plain.getEstimator().getStages()))
    want = trees.search_results(spark, whole.fit(rows), grid).collect()
    search = trees.cross_validated(regressor(kind).setWeightCol(trees.WEIGHT), grid, LEVELS, "fold")
    got = trees.search_results(spark, search.fit(small), grid).collect()
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r.avg_rmse for r in got] == pytest.approx([r.avg_rmse for r in want], abs=1e-9)
    # The limits of the grid count here.
    assert len({round(r.avg_rmse, 6) for r in want}) >= 3


def test_counted_rows_keep_number_and_rows_of_small_nodes(spark):
    rows = spark.createDataFrame([(1, None)] * 7 + [(2, 1)] * 2 + [(3, 1)], "label int, fold int")
    one = sorted(tuple(r) for r in trees.counted(rows).collect())
    assert [(r[0], r[2]) for r in one] == [(1, 7.0), (2, 2.0), (3, 1.0)]
    three = sorted((r.label, r.weight) for r in trees.counted(rows, 3).collect())
    assert three == [(1, 1.0), (1, 1.0), (1, 5.0), (2, 1.0), (2, 1.0), (3, 1.0)]


def test_depths_that_no_tree_reaches_share_a_fit(spark, monkeypatch):
    fits = []
    fit = Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    grid = {"maxIter": (1, 2), "maxDepth": (1, 4, 7, 9), "stepSize": (0.1, 0.5)}
    search = trees.cross_validated(regressor("gbt"), grid, LEVELS, "fold")
    found = search.fit(fold_levels(spark))
    # Per fold and step size the depths 9 and 1: five levels are at most four splits deep.
    assert len(fits) <= 3 * 2 * 3 + 1 and len(fits) < 3 * 2 * 4 + 1
    by_setting = {tuple(m.values()): v for m, v in zip(found.getEstimatorParamMaps(), found.avgMetrics)}
    assert len(by_setting) == 16


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_a_part_asks_java_about_no_tree(spark, rows, kind):
    size = {"gbt": "maxIter", "rf": "numTrees"}[kind]
    whole = trees.regression_chain(regressor(kind, **{size: 5}), SETTINGS).fit(rows).stages[-1]
    part = prefixes.first_trees(whole, 3)
    assert "trees" not in vars(part)
    assert (part.getOrDefault(size), len(part.trees), len(whole.trees)) == (3, 3, 5)
