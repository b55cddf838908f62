import os
import re
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rainlane.operators.unpack import pack_documents, unpack_days
from rainlane.plans import daily
from rainlane.plans.trusted import build_trusted
from rainlane.schemas import INCIDENT_EXTRACT, TRUSTED, WEATHER_DAYS
from rainlane.settings import Layout, Settings
from rainlane.sinks.raw import land_documents, land_extract
from rainlane.sources.documents import read_weather_documents
from rainlane.sources.extracts import read_extract
from rainlane.staging import remove
from rainlane.streaming import arrivals
from rainlane.streaming.arrivals import ingest_incidents, ingest_weather, landed_rows
from rainlane.streaming.ledger import SIDES, arrival_counts, entries_of, landed_files, rejected
from rainlane.streaming.refresh import catch_up, listings_of, refresh_trusted

SETTINGS = Settings()
START = date(2022, 1, 1)


def arrive_incidents(spark, layout, *days):
    rows = [(f"{d}-{n}", "M", str(d % 7), "Bajo", (START + timedelta(days=d)).isoformat()) for n, d in enumerate(days)]
    land_extract(spark.createDataFrame(rows, INCIDENT_EXTRACT), layout.raw_incidents, "append")


def arrive_weather(spark, layout, *days):
    rows = [(START + timedelta(days=d), 20.0 + d, d / 2) for d in days]
    docs = pack_documents(spark.createDataFrame(rows, WEATHER_DAYS))
    land_documents(docs, layout.raw_weather, "append")


def rows_of(df):
    return Counter(map(tuple, df.select(TRUSTED.fieldNames()).collect()))


def full_rebuild(spark, layout):
    days = unpack_days(read_weather_documents(spark, layout.raw_weather))
    return rows_of(build_trusted(days, read_extract(spark, layout.raw_incidents), SETTINGS))


def test_each_file_is_taken_in_once(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 1, 2)
    arrive_weather(spark, layout, 0, 1)

    def counts():
        one_by_one = Settings(files_per_batch=1)
        ingest_incidents(spark, layout, one_by_one).awaitTermination()
        ingest_weather(spark, layout, one_by_one).awaitTermination()
        return tuple(
            spark.read.parquet(p).count() for p in (layout.landed_incidents, layout.landed_weather)
        )

    assert counts() == (3, 2)
    assert counts() == (3, 2)
    arrive_incidents(spark, layout, 5)
    arrive_weather(spark, layout, 400)
    assert counts() == (4, 3)


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 0, 40, 80)
    arrive_weather(spark, layout, 0, 40)
    assert rows_of(catch_up(spark, layout, SETTINGS)) == full_rebuild(spark, layout)
    # Weather that comes later than its incidents, a day that comes twice.
    arrive_weather(spark, layout, 80, 0)
    assert rows_of(catch_up(spark, layout, SETTINGS)) == full_rebuild(spark, layout)
    arrive_incidents(spark, layout, 40, 81)
    got = rows_of(catch_up(spark, layout, SETTINGS))
    assert got == full_rebuild(spark, layout)
    assert sum(got.values()) == 7


def test_refresh_leaves_other_months_alone(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 40)
    arrive_weather(spark, layout, 0, 40, 41)
    catch_up(spark, layout, SETTINGS)

    def files(month):
        return sorted(p.name for p in (tmp_path / "trusted" / "joined_by_month" / f"month={month}").glob("*.parquet"))

    january, february = files("2022-01-01"), files("2022-02-01")
    arrive_incidents(spark, layout, 41)
    assert catch_up(spark, layout, SETTINGS).count() == 3
    assert files("2022-01-01") == january
    assert files("2022-02-01") != february
    assert refresh_trusted(spark, layout, SETTINGS) == []
    assert files("2022-01-01") == january


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 1)
    arrive_weather(spark, layout, 0, 1)
    before = rows_of(catch_up(spark, layout, SETTINGS))
    # The refresh failed before it noted what the month was built from.
    remove(spark, layout.trusted_sources)
    assert refresh_trusted(spark, layout, SETTINGS) == [date(2022, 1, 1)]
    assert rows_of(spark.read.schema(TRUSTED).parquet(layout.trusted_by_month)) == before


def test_one_side_may_come_first(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0)
    assert catch_up(spark, layout, SETTINGS).count() == 0
    arrive_weather(spark, layout, 0)
    assert catch_up(spark, layout, SETTINGS).count() == 1


def test_rows_without_a_date_are_landed_but_not_trusted(spark, tmp_path):
    layout = Layout(str(tmp_path))
    bad = spark.createDataFrame([("1", "M", "3", "Bajo", "nope")], INCIDENT_EXTRACT)
    land_extract(bad, layout.raw_incidents)
    arrive_incidents(spark, layout, 3)
    arrive_weather(spark, layout, 3)
    assert catch_up(spark, layout, SETTINGS).count() == 1
    landed = spark.read.parquet(layout.landed_incidents)
    assert landed.count() == 2 and landed.where(F.col("date").isNull()).count() == 1


def test_nothing_has_arrived_yet(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert not daily.run_on_arrival(spark, layout)


def test_a_failed_run_is_taken_up_again(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0)
    arrive_weather(spark, layout, 0)
    refined = []

    def fail(*_):
        raise RuntimeError("out of order")

    monkeypatch.setattr(daily, "refine", fail)
    with pytest.raises(Exception, match="out of order"):
        daily.run_on_arrival(spark, layout)
    monkeypatch.setattr(daily, "refine", lambda trusted, *_: refined.append(trusted.count()))
    assert daily.run_on_arrival(spark, layout)
    assert not daily.run_on_arrival(spark, layout)
    arrive_incidents(spark, layout, 0)
    assert daily.run_on_arrival(spark, layout)
    assert refined == [1, 2]


def whole_export(spark, layout, *numbers):
    rows = [(f"{d}", "M", str(n), "Bajo", (START + timedelta(days=d)).isoformat()) for d, n in enumerate(numbers)]
    land_extract(spark.createDataFrame(rows, INCIDENT_EXTRACT).coalesce(1), layout.raw_incidents)


def test_a_repeated_export_replaces_the_former_one(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_weather(spark, layout, 0, 1, 40)
    whole_export(spark, layout, 5, 6)
    assert catch_up(spark, layout, SETTINGS).count() == 2
    whole_export(spark, layout, 7, 6)
    again = catch_up(spark, layout, SETTINGS)
    assert rows_of(again) == full_rebuild(spark, layout)
    assert sorted(r.reported_incidents for r in again.collect()) == [6, 7]


def test_a_rewritten_file_replaces_its_rows(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_weather(spark, layout, 0, 1, 2, 40)
    folder = tmp_path / "raw" / "mysql"
    folder.mkdir(parents=True)
    head = "id,city,reported_incidents,congestion_level,incident_date\n"
    day = [(START + timedelta(days=d)).isoformat() for d in range(60)]
    (folder / "year.csv").write_text(f"{head}1,M,5,Bajo,{day[0]}\n2,M,6,Bajo,{day[40]}\n")
    assert catch_up(spark, layout, SETTINGS).count() == 2
    for n in (8, 9):
        (folder / "year.csv").write_text(f"{head}1,M,{n},Bajo,{day[0]}\n3,M,{n},Bajo,{day[1]}\n")
        got = catch_up(spark, layout, SETTINGS)
        assert rows_of(got) == full_rebuild(spark, layout)
        assert [r.reported_incidents for r in got.collect()] == [n, n]
        os.utime(folder / "year.csv", (n * 1e6, n * 1e6))
    (folder / "year.csv").unlink()
    assert catch_up(spark, layout, SETTINGS).count() == 0


def test_a_back_dated_file_is_read(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0)
    arrive_weather(spark, layout, 0, 1)
    assert catch_up(spark, layout, SETTINGS).count() == 1
    arrive_incidents(spark, layout, 1)
    newest = max((tmp_path / "raw" / "mysql").glob("part*"), key=lambda p: p.stat().st_mtime_ns)
    os.utime(newest, (1e9, 1e9))
    assert catch_up(spark, layout, SETTINGS).count() == 2


@pytest.mark.parametrize("line", ["4,M,5,Bajo", "4,M,5,Bajo,2022-01-01,more"])
def test_a_line_with_other_fields_raises(spark, tmp_path, line):
    layout = Layout(str(tmp_path))
    (tmp_path / "raw" / "mysql").mkdir(parents=True)
    head = "id,city,reported_incidents,congestion_level,incident_date\n"
    (tmp_path / "raw" / "mysql" / "a.csv").write_text(f"{head}1,M,5,Bajo,2022-01-01\n{line}\n")
    kept = read_extract(spark, layout.raw_incidents, corrupt="keep")
    assert [r._corrupt_record for r in kept.collect()] == [None, line]
    with pytest.raises(Exception, match="corrupt input"):
        read_extract(spark, layout.raw_incidents).select("id").collect()
    with pytest.raises(Exception, match="corrupt input"):
        catch_up(spark, layout, SETTINGS)


def test_a_cut_off_document_raises(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_weather(spark, layout, 0)
    (tmp_path / "raw" / "api" / "cut.json").write_text('{"daily": {"time": ["2022-01-02"')
    kept = read_weather_documents(spark, layout.raw_weather, corrupt="keep").collect()
    assert sum(r._corrupt_record is not None for r in kept) == 1
    with pytest.raises(Exception, match="corrupt input"):
        read_weather_documents(spark, layout.raw_weather).count()


def test_a_refresh_reads_the_changed_months_only(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 40)
    arrive_weather(spark, layout, 0, 40)
    catch_up(spark, layout, SETTINGS)
    rows = landed_rows(spark, layout, "weather").where(F.col("month").isin([date(2022, 2, 1)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month", plan)
    assert rows.count() == 1


def test_texts_keep_their_blanks(spark, tmp_path):
    path = str(tmp_path / "csv")
    land_extract(spark.createDataFrame([("  Cali ", " Bajo")], "id string, city string"), path)
    schema = spark.createDataFrame([], "id string, city string").schema
    assert read_extract(spark, path, schema).collect() == [("  Cali ", " Bajo")]


ASIDE = replace(SETTINGS, corrupt="set_aside")


def test_a_refresh_does_not_read_landed_rows_of_other_months(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 40)
    arrive_weather(spark, layout, 0, 40, 41)
    catch_up(spark, layout, SETTINGS)
    for side in SIDES:
        for path in (tmp_path / "landed" / "rows" / side).glob("batch=*/month=2022-01-01/*.parquet"):
            path.write_bytes(b"no parquet")
    arrive_incidents(spark, layout, 41)
    assert refresh_trusted(spark, layout, SETTINGS) == []
    assert catch_up(spark, layout, SETTINGS).count() == 3


def test_corrupt_input_is_set_aside(spark, tmp_path):
    """One cut-off document among three files: the others arrive; repaired, it arrives too."""
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 1, 2)
    arrive_weather(spark, layout, 0)
    arrive_weather(spark, layout, 1)
    cut = tmp_path / "raw" / "api" / "cut.json"
    whole = '{"daily": {"time": ["2022-01-03"], "temperature_2m_max": [22.5], "precipitation_sum": [0.5]}}'
    cut.write_text(whole[:40])
    (tmp_path / "raw" / "mysql" / "a.csv").write_text("id,city,reported_incidents,congestion_level,incident_date\n8,M,5,Bajo\n9,M,5,Bajo,2022-01-01\n")

    def counts():
        return {r.stage: r.n_rows for r in arrival_counts(spark, layout, listings_of(spark, layout)).collect()}

    assert catch_up(spark, layout, ASIDE).count() == 3
    assert counts()["weather_rejected"] == counts()["incidents_rejected"] == 1
    assert (counts()["weather_files"], counts()["weather_rows"], counts()["incidents_rows"]) == (3, 2, 4)
    listings = listings_of(spark, layout)
    assert [r.record for r in rejected(spark, layout, "weather", listings["weather"]).collect()] == [whole[:40]]
    row = rejected(spark, layout, "incidents", listings["incidents"]).first()
    assert row.record == "8,M,5,Bajo" and row.source_file.endswith("a.csv")
    cut.write_text(whole)
    os.utime(cut, (2e9, 2e9))
    assert catch_up(spark, layout, ASIDE).count() == 4
    assert (counts()["weather_rejected"], counts()["weather_rows"]) == (0, 3)
    assert rejected(spark, layout, "weather", listings_of(spark, layout)["weather"]).count() == 0


def test_the_daily_run_sets_corrupt_input_aside(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 1)
    arrive_weather(spark, layout, 0, 1)
    (tmp_path / "raw" / "api" / "cut.json").write_text('{"daily": {"time": [')
    with pytest.raises(Exception, match="corrupt input"):
        daily.run_daily(spark, layout, SETTINGS, with_models=False)
    daily.run_daily(spark, layout, ASIDE, with_models=False)
    counts = {r.stage: r.n_rows for r in spark.read.parquet(layout.stage_counts).collect()}
    assert counts == {
        "rejected_weather": 1, "rejected_incidents": 0, "weather_documents": 1, "weather_days": 2,
        "incident_rows": 2, "joined_rows": 2,
    }
    assert [r.record for r in spark.read.parquet(layout.raw_rejected("weather")).collect()] == ['{"daily": {"time": [']


def rows_on_disk(spark, layout, side="incidents"):
    return spark.read.parquet(layout.landed(side)).count()


def test_compaction_keeps_one_copy(spark, tmp_path):
    """Ten times the same export: each is landed, and the landed table holds one in the end."""
    layout, once = Layout(str(tmp_path)), replace(SETTINGS, dead_share=2.0)
    arrive_weather(spark, layout, 0, 1, 40)
    sizes = []
    for n in range(10):
        whole_export(spark, layout, n, 6)
        ingest_incidents(spark, layout, once).awaitTermination()
        listing = arrivals.list_raw(spark, layout, "incidents")
        arrivals.land_unknown(spark, layout, "incidents", once, listing)
        arrivals.compact(spark, layout, "incidents", once, listing)
        sizes.append(rows_on_disk(spark, layout))
    assert max(sizes) <= 6 and sizes.count(2) >= 2
    arrivals.compact(spark, layout, "incidents", replace(once, dead_share=0.0), arrivals.list_raw(spark, layout, "incidents"))
    assert rows_on_disk(spark, layout) == 2
    assert rows_of(catch_up(spark, layout, SETTINGS)) == full_rebuild(spark, layout)
    assert refresh_trusted(spark, layout, SETTINGS) == []


def test_a_compaction_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    layout, always = Layout(str(tmp_path)), replace(SETTINGS, dead_share=0.0)
    arrive_weather(spark, layout, 0, 1)
    whole_export(spark, layout, 5, 6)
    catch_up(spark, layout, SETTINGS)
    whole_export(spark, layout, 7, 8)

    def fail(*_, **__):
        raise RuntimeError("out of order")

    for step in ("note", "forget"):
        with monkeypatch.context() as patch:
            patch.setattr(arrivals, step, fail)
            listing = arrivals.list_raw(spark, layout, "incidents")
            if step == "note":
                patch.setattr(arrivals, step, arrivals_note_failing_on_compaction(fail))
                ingest_incidents(spark, layout, SETTINGS).awaitTermination()
            with pytest.raises(Exception, match="out of order"):
                arrivals.compact(spark, layout, "incidents", always, listing)
        live = landed_files(spark, layout, "incidents").join(listing, ["source_file", "source_time"], "left_semi")
        assert sorted(r.reported_incidents for r in landed_rows(spark, layout, "incidents", live).collect()) == [7, 8]
    # The second time the new batch counts, and what it took the place of is still there, but void.
    assert rows_on_disk(spark, layout) == 4
    void = {name for r in entries_of(spark, layout, "incidents").where("size(replaces) > 0").collect() for name in r.replaces}
    assert void and void & {r.batch for r in entries_of(spark, layout, "incidents").collect()} == void
    assert rows_of(catch_up(spark, layout, always)) == full_rebuild(spark, layout)


def arrivals_note_failing_on_compaction(fail):
    from rainlane.streaming.ledger import note

    return lambda entries, layout, side, batch, replaces=None: fail() if replaces else note(entries, layout, side, batch)


def test_a_batch_that_is_landed_again_counts_once(spark, tmp_path):
    """A stream that forgot that it was done; the second batch has the same name."""
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0, 1)
    arrive_weather(spark, layout, 0, 1)
    first = rows_of(catch_up(spark, layout, SETTINGS))
    remove(spark, layout.checkpoint("incidents"))
    assert rows_of(catch_up(spark, layout, SETTINGS)) == first
    assert rows_on_disk(spark, layout) == 2


def test_files_without_rows_are_read_once(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0)
    head = "id,city,reported_incidents,congestion_level,incident_date\n"
    (tmp_path / "raw" / "mysql" / "empty (1).csv").write_text(head)
    for _ in range(2):
        catch_up(spark, layout, SETTINGS)
        assert arrivals.list_raw(spark, layout, "incidents").count() == landed_files(spark, layout, "incidents").select("source_file").distinct().count()
    (tmp_path / "raw" / "mysql" / "empty (1).csv").write_text(f"{head}1,M,5,Bajo,2022-01-01\n")
    os.utime(tmp_path / "raw" / "mysql" / "empty (1).csv", (2e9, 2e9))
    arrive_weather(spark, layout, 0)
    assert catch_up(spark, layout, SETTINGS).count() == 2


def test_names_like_globs_are_refused(spark, tmp_path):
    layout = Layout(str(tmp_path))
    arrive_incidents(spark, layout, 0)
    arrive_weather(spark, layout, 0)
    (tmp_path / "raw" / "mysql" / "a[1].csv").write_text("id,city,reported_incidents,congestion_level,incident_date\n")
    with pytest.raises(ValueError, match="must not have"):
        catch_up(spark, layout, SETTINGS)
