import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rainlane.operators import charts, metrics, summary
from rainlane.plans.analysis import analyse
from rainlane.plans.charting import chart_datasets
from rainlane.plans.descriptive import descriptive
from rainlane.schemas import CONGESTION_STATS, CORRELATIONS, GLOBAL_STATS, TRUSTED
from rainlane.settings import Settings

SETTINGS = Settings()


def trusted_rows(n=400, seed=11, gaps=True):
    rng = random.Random(seed)

    def maybe(value):
        return None if gaps and rng.random() < 0.05 else value

    return [
        (
            date(2022, 1, 1) + timedelta(days=i),
            str(i),
            "M",
            maybe(rng.randint(0, 30)),
            maybe(round(rng.uniform(18, 30), 1)),
            maybe(round(max(0.0, rng.gauss(2, 6)), 1)),
            rng.randint(1, 3),
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return trusted_rows()


@pytest.fixture(scope="module")
def frame(rows):
    return pd.DataFrame(rows, columns=TRUSTED.fieldNames()).astype(
        {"reported_incidents": float, "max_temp": float, "precipitation": float}
    )


@pytest.fixture(scope="module")
def trusted(spark, rows):
    return spark.createDataFrame(rows, TRUSTED).cache()


def test_global_stats(trusted, frame):
    got = summary.global_stats(trusted).first().asDict()
    incidents = frame.reported_incidents
    assert got == pytest.approx(
        {
            "min_incidents": incidents.min(),
            "max_incidents": incidents.max(),
            "avg_incidents": incidents.mean(),
            "std_incidents": incidents.std(),
            "min_temp": frame.max_temp.min(),
            "max_temp": frame.max_temp.max(),
            "avg_temp": frame.max_temp.mean(),
            "min_precip": frame.precipitation.min(),
            "max_precip": frame.precipitation.max(),
            "avg_precip": frame.precipitation.mean(),
        }
    )


def test_one_row_and_no_row(trusted):
    one = summary.global_stats(trusted.where("id = '1'")).first()
    assert one.std_incidents is None and one.min_temp == one.max_temp
    none = summary.global_stats(trusted.where("id = 'x'")).first()
    assert set(none.asDict().values()) == {None}
    assert summary.level_stats(trusted.where("id = 'x'")).collect() == []


def test_level_stats_are_ordered(trusted, frame):
    got = summary.level_stats(trusted).collect()
    assert [r.congestion_level_num for r in got] == [1, 2, 3]
    for r in got:
        part = frame[frame.congestion_level_num == r.congestion_level_num]
        assert r.days_count == len(part)
        assert r.avg_incidents == pytest.approx(part.reported_incidents.mean())
        assert r.avg_temp == pytest.approx(part.max_temp.mean())
        assert r.avg_precip == pytest.approx(part.precipitation.mean())


def test_correlations(trusted, frame):
    got = summary.correlations(trusted).first()
    want = frame[["reported_incidents", "max_temp", "precipitation", "congestion_level_num"]].corr()
    assert got.temp_corr == pytest.approx(want.iloc[0, 1])
    assert got.precip_corr == pytest.approx(want.iloc[0, 2])
    assert got.congestion_corr == pytest.approx(want.iloc[0, 3])


def values(df):
    return [v for r in df.collect() for v in r]


def test_descriptive_tables_from_either_plan(trusted):
    tables, from_cube = descriptive(trusted), analyse(trusted, SETTINGS).tables
    assert tables.keys() == from_cube.keys()
    for name, schema in {
        "global_stats": GLOBAL_STATS,
        "congestion_stats": CONGESTION_STATS,
        "correlations": CORRELATIONS,
    }.items():
        for table in (tables[name], from_cube[name]):
            assert table.schema.simpleString() == schema.simpleString()
        assert values(from_cube[name]) == pytest.approx(values(tables[name]), abs=1e-12)


def brute_bars(frame, column):
    cut = pd.cut(frame[column], bins=8, labels=False)
    groups = frame.assign(bin=cut).dropna(subset=["bin"]).groupby(["bin", "congestion_level_num"])
    return {
        (int(b), level): (g.reported_incidents.mean(), len(g)) for (b, level), g in groups
    }


@pytest.mark.parametrize("column, kind", [("max_temp", "temp_incidents_bar"), ("precipitation", "precip_incidents_bar")])
def test_binned_means(trusted, frame, column, kind):
    value, level = "reported_incidents", "congestion_level_num"
    direct = charts.binned_mean(trusted, column, 8, value, level)
    from_cube = analyse(trusted, SETTINGS).datasets[kind]
    assert sorted(direct.columns) == sorted(from_cube.columns)
    columns = sorted(direct.columns)
    assert sorted(direct.select(columns).collect()) == sorted(from_cube.select(columns).collect())
    got = {(r.bin, r[level]): (r.mean_reported_incidents, r.n_rows) for r in direct.collect()}
    want = brute_bars(frame, column)
    assert got.keys() == want.keys()
    for key, (mean, n) in want.items():
        assert got[key][0] == pytest.approx(mean) and got[key][1] == n
    assert sum(n for _, n in got.values()) == frame[column].notna().sum()
    for r in direct.collect():
        assert r.lower < r.upper


def test_level_totals(trusted, frame):
    want = frame.groupby("congestion_level_num").reported_incidents.sum()
    for data in (
        charts.level_totals(trusted, "reported_incidents", "congestion_level_num"),
        chart_datasets(trusted, SETTINGS)["congestion_incidents_bar"],
        analyse(trusted, SETTINGS).datasets["congestion_incidents_bar"],
    ):
        assert {r.congestion_level_str: r.total_incidents for r in data.collect()} == {
            str(level): total for level, total in want.items()
        }


@pytest.mark.parametrize("plan", [chart_datasets, lambda t, s: analyse(t, s).datasets])
def test_charts_of_a_table_with_one_value(spark, plan):
    rows = [(date(2022, 1, i), str(i), "M", i, 20.0, 0.0, 1) for i in range(1, 5)]
    data = plan(spark.createDataFrame(rows, TRUSTED), SETTINGS)
    assert [(r.bin, r.n_rows) for r in data["temp_incidents_bar"].collect()] == [(3, 4)]
    assert [(r.bin, r.n_rows) for r in data["precip_incidents_bar"].collect()] == [(3, 4)]


@pytest.mark.parametrize("plan", [chart_datasets, lambda t, s: analyse(t, s).datasets])
def test_charts_without_rows_and_without_weather(spark, plan):
    empty = plan(spark.createDataFrame([], TRUSTED), SETTINGS)
    assert [empty[k].count() for k in sorted(empty)] == [0, 16, 0, 0]
    rows = [(date(2022, 1, i), str(i), "M", i, None, float("nan"), 1) for i in range(1, 5)]
    data = plan(spark.createDataFrame(rows, TRUSTED), SETTINGS)
    assert data["temp_incidents_bar"].collect() == data["precip_incidents_bar"].collect() == []
    assert [tuple(r) for r in data["congestion_incidents_bar"].collect()] == [("1", 10)]


def scored(spark, n=300):
    rng = random.Random(4)
    rows = [(rng.randint(0, 20), rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(n)]
    return spark.createDataFrame(rows, "label int, a double, b double")


def test_metrics_equal_the_evaluator(spark):
    df = scored(spark)
    got = {r.model: r for r in metrics.regression_metrics(df, "label", {"A": "a", "B": "b"}).collect()}
    for model, column in {"A": "a", "B": "b"}.items():
        for name in ("rmse", "mae"):
            want = RegressionEvaluator(labelCol="label", predictionCol=column, metricName=name).evaluate(df)
            assert got[model][name] == pytest.approx(want)


def test_report_names_the_lower_rmse(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 2.0)], "label int, a double, b double")
    report = metrics.evaluation_report(df, "label", {"A": "a", "B": "b"}).collect()
    assert [(r.model, r.best_model) for r in report] == [("A", None), ("B", None), ("Best Model", "A")]
    assert report[2].rmse is None and report[2].mae is None
    assert len({r.evaluation_timestamp for r in report}) == 1


def test_equal_rmse_goes_to_the_second(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0)], "label int, a double, b double")
    assert metrics.best_model(df, "label", {"A": "a", "B": "b"}).first()[0] == "B"
    assert metrics.best_model(df.limit(0), "label", {"A": "a", "B": "b"}).first()[0] == "B"


def test_metrics_take_one_pass(spark):
    df = scored(spark)
    report = metrics.evaluation_report(df, "label", {"A": "a", "B": "b"}, F.lit(None).cast("timestamp"))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
