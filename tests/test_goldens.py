"""The whole way from raw files to served tables on rows small enough to work out by hand."""

from datetime import date

import pytest

from rainlane.plans.analysis import analyse
from rainlane.plans.daily import write_trusted
from rainlane.schemas import TRUSTED
from rainlane.settings import Layout, Settings
from rainlane.sources.tables import read_table

# Days 1 to 4 have 10, 20, 30 and 40 degrees and 0, 2, 4 and no millimetres of rain.
WEATHER = """{"latitude": 6.25, "daily": {
  "time": ["2022-01-01", "2022-01-02", "2022-01-03", "2022-01-04"],
  "temperature_2m_max": [10.0, 20.0, 30.0, 40.0],
  "precipitation_sum": [0.0, 2.0, 4.0, null]}}"""

INCIDENTS = """id,city,reported_incidents,congestion_level,incident_date
1,Medellin,1,Bajo,2022-01-01
2,Medellin,2,Medio,2022-01-02
3,Medellin,3,Alto,2022-01-03
4,Medellin,6,Bajo,2022-01-04
5,Medellin,9,Bajo,2022-02-09
6,Medellin,9,Bajo,nope
"""


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("goldens")
    for name, content in (("api/w.json", WEATHER), ("mysql/i.csv", INCIDENTS)):
        file = root / "raw" / name
        file.parent.mkdir(parents=True)
        file.write_text(content)
    layout = Layout(str(root))
    write_trusted(spark, layout, Settings())
    return layout


@pytest.fixture(scope="module")
def analysis(spark, layout):
    return analyse(read_table(spark, layout.trusted, TRUSTED), Settings(bins=3))


def test_trusted(spark, layout):
    rows = read_table(spark, layout.trusted, TRUSTED).collect()
    assert sorted(map(tuple, rows)) == [
        (date(2022, 1, 1), "1", "Medellin", 1, 10.0, 0.0, 1),
        (date(2022, 1, 2), "2", "Medellin", 2, 20.0, 2.0, 2),
        (date(2022, 1, 3), "3", "Medellin", 3, 30.0, 4.0, 3),
        (date(2022, 1, 4), "4", "Medellin", 6, 40.0, None, 1),
    ]


def test_stage_counts(spark, layout):
    counts = {r.stage: r.n_rows for r in spark.read.parquet(layout.stage_counts).collect()}
    assert counts == {"weather_documents": 1, "weather_days": 4, "incident_rows": 6, "joined_rows": 4}


def test_statistics(analysis):
    overall = analysis.tables["global_stats"].first()
    # Mean 12 / 4; squares of the deviations 4 + 1 + 0 + 9 over 3.
    assert (overall.min_incidents, overall.max_incidents, overall.avg_incidents) == (1, 6, 3.0)
    assert overall.std_incidents == pytest.approx((14 / 3) ** 0.5)
    assert (overall.avg_temp, overall.avg_precip) == (25.0, 2.0)
    levels = {tuple(r) for r in analysis.tables["congestion_stats"].collect()}
    assert levels == {(1, 2, 3.5, 25.0, 0.0), (2, 1, 2.0, 20.0, 2.0), (3, 1, 3.0, 30.0, 4.0)}


def test_correlations(analysis):
    row = analysis.tables["correlations"].first()
    # Temperature: 80 / sqrt(500 * 14). Rain, without the fourth day: a straight line.
    assert row.temp_corr == pytest.approx(80 / (500 * 14) ** 0.5)
    assert row.precip_corr == pytest.approx(1.0) and row.precip_corr <= 1.0


def test_bars(analysis):
    bars = {(r.bin, r.congestion_level_num, r.mean_reported_incidents) for r in analysis.datasets["temp_incidents_bar"].collect()}
    # Edges at 20 and 30 belong to the bins below them.
    assert bars == {(0, 1, 1.0), (0, 2, 2.0), (1, 3, 3.0), (2, 1, 6.0)}
    totals = {r.congestion_level_str: r.total_incidents for r in analysis.datasets["congestion_incidents_bar"].collect()}
    assert totals == {"1": 7, "2": 2, "3": 3}
