"""Golden values of a captured year of inputs; run with --captured FOLDER."""

import pytest

from rainlane.operators import charts, summary
from rainlane.operators.unpack import unpack_days
from rainlane.plans.analysis import analyse
from rainlane.plans.trusted import build_trusted
from rainlane.settings import Layout, Settings
from rainlane.sources.documents import read_weather_documents
from rainlane.sources.extracts import read_extract

TEMPERATURE = """
(0,3,16.0,1) (1,2,14.0,1) (1,3,19.0,3) (2,2,12.444444444,9) (2,3,18.235294118,17) (3,1,6.5,2)
(3,2,12.52173913,23) (3,3,18.291666667,24) (4,1,5.2,5) (4,2,12.2,35) (4,3,17.53968254,63)
(5,1,6.714285714,7) (5,2,12.375,40) (5,3,16.981481481,54) (6,1,6.4,5) (6,2,12.310344828,29)
(6,3,17.0,38) (7,1,8.0,1) (7,3,18.125,8)"""
PRECIPITATION = """
(0,1,6.0,16) (0,2,12.343283582,67) (0,3,17.172043011,93) (1,2,12.333333333,30) (1,3,17.516129032,31)
(2,1,7.5,4) (2,2,12.55,20) (2,3,17.580645161,31) (3,2,11.727272727,11) (3,3,17.875,32) (4,2,13.5,4)
(4,3,18.166666667,12) (5,2,11.0,2) (5,3,17.25,8) (6,2,13.0,2) (7,2,14.0,1) (7,3,22.0,1)"""


@pytest.fixture(scope="module")
def trusted(spark, request):
    folder = request.config.getoption("--captured")
    if folder is None:
        pytest.skip("no captured inputs given")
    layout = Layout(folder)
    days = unpack_days(read_weather_documents(spark, f"{layout.raw_weather}/*.json"))
    extract = read_extract(spark, f"{layout.raw_incidents}/*.csv")
    return build_trusted(days, extract, Settings()).cache()


def test_rows(trusted):
    assert trusted.count() == 365
    assert trusted.select("city").distinct().count() == 1


def test_statistics(trusted):
    got = summary.global_stats(trusted).first().asDict()
    assert got == pytest.approx(
        {
            "min_incidents": 3, "max_incidents": 23, "avg_incidents": 14.942465753424658,
            "std_incidents": 3.7002345414309454, "min_temp": 20.2, "max_temp": 28.2,
            "avg_temp": 25.157808219178055, "min_precip": 0.0, "max_precip": 32.3,
            "avg_precip": 6.472602739726027,
        },
        abs=1e-9,
    )
    levels = [tuple(r) for r in summary.level_stats(trusted).collect()]
    assert [v for row in levels for v in row] == pytest.approx(
        [
            1, 20, 6.3, 25.73, 2.32,
            2, 137, 12.357664233576642, 25.13576642335768, 5.966423357664232,
            3, 208, 17.47596153846154, 25.117307692307705, 7.20528846153846,
        ],
        abs=1e-9,
    )
    totals = charts.level_totals(trusted, "reported_incidents", "congestion_level_num")
    assert {tuple(r) for r in totals.collect()} == {("1", 126), ("2", 1693), ("3", 3635)}


def test_correlations(trusted):
    names = ["reported_incidents", "max_temp", "precipitation", "congestion_level_num"]
    got = {(r.row_var, r.col_var): r.r for r in summary.correlation_matrix(trusted, names).collect()}
    upper = [got[a, b] for i, a in enumerate(names) for b in names[i + 1 :]]
    assert upper == pytest.approx(
        [
            -0.1171799197518885, 0.21509223692334054, 0.8655490777168634,
            -0.3321745308255672, -0.07266699881425297, 0.16830200178761703,
        ],
        abs=1e-9,
    )


@pytest.mark.parametrize(
    "column, kind, want",
    [
        ("max_temp", "temp_incidents_bar", TEMPERATURE),
        ("precipitation", "precip_incidents_bar", PRECIPITATION),
    ],
)
def test_bins(trusted, column, kind, want):
    bars = [eval(entry) for entry in want.split()]
    direct = charts.binned_mean(trusted, column, 8, "reported_incidents", "congestion_level_num")
    for data in (direct, analyse(trusted, Settings()).datasets[kind]):
        rows = data.select("bin", "congestion_level_num", "mean_reported_incidents", "n_rows")
        assert [v for r in sorted(rows.collect()) for v in r] == pytest.approx(
            [v for bar in bars for v in bar], abs=1e-8
        )
