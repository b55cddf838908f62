import json
import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from rainlane.operators.counts import stage_counts
from rainlane.operators.joining import measured_bytes, sliced_join
from rainlane.operators.unpack import pack_documents, unpack_days
from rainlane.plans.trusted import build_trusted, typed_incidents
from rainlane.schemas import INCIDENT_EXTRACT, TRUSTED, WEATHER_DAYS, WEATHER_DOCUMENT
from rainlane.settings import Settings
from rainlane.sinks.raw import land_documents, land_extract
from rainlane.sources.documents import read_weather_documents
from rainlane.sources.extracts import read_extract

SETTINGS = Settings()


def write_document(folder, name, time, temp, precip, indent=None):
    document = {
        "latitude": 6.2,
        "daily_units": {"time": "iso8601"},
        "daily": {"time": time, "temperature_2m_max": temp, "precipitation_sum": precip},
    }
    (folder / name).write_text(json.dumps(document, indent=indent), encoding="utf-8")


def test_documents_are_unpacked_by_position(spark, tmp_path):
    write_document(tmp_path, "a.json", ["2022-01-01", "2022-01-02"], [20.5, 21], [0, 1.5], indent=2)
    write_document(tmp_path, "b.json", ["2022-01-03", "x", "2022-01-05"], [22.0], [None, 2.0])
    write_document(tmp_path, "c.json", [], [], [])
    write_document(tmp_path, "d.json", None, [1.0], [1.0])
    write_document(tmp_path, "e.json", ["2022-01-09"], None, [1.0])
    docs = read_weather_documents(spark, f"{tmp_path}/*.json")
    assert docs.schema == WEATHER_DOCUMENT
    assert docs.count() == 5
    days = unpack_days(docs)
    assert days.schema == WEATHER_DAYS
    assert Counter(map(tuple, days.collect())) == Counter(
        [
            (date(2022, 1, 1), 20.5, 0.0),
            (date(2022, 1, 2), 21.0, 1.5),
            (date(2022, 1, 3), 22.0, None),
            (None, None, 2.0),
            (date(2022, 1, 5), None, None),
        ]
    )


def test_only_the_three_arrays_are_read(spark, tmp_path):
    write_document(tmp_path, "a.json", ["2022-01-01"], [20.5], [0.0])
    days = unpack_days(read_weather_documents(spark, str(tmp_path)))
    plan = days._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :]
    assert "temperature_2m_max" in schema and "latitude" not in schema


def test_packing_is_undone_by_unpacking(spark, tmp_path):
    rows = [(date(2020 + y, m, 1), float(m), None if m == 3 else 0.5 * m) for y in range(3) for m in range(1, 13)]
    days = spark.createDataFrame(rows, WEATHER_DAYS)
    land_documents(pack_documents(days), str(tmp_path / "docs"))
    docs = read_weather_documents(spark, str(tmp_path / "docs"))
    assert docs.count() == 3
    assert Counter(map(tuple, unpack_days(docs).collect())) == Counter(rows)


def test_packing_by_month_and_repeated_dates(spark):
    rows = [(date(2022, 1, 1), 1.0, None), (date(2022, 1, 2), None, 2.0), (date(2022, 3, 1), 3.0, 3.0)]
    days = spark.createDataFrame(rows, WEATHER_DAYS)
    docs = pack_documents(days, per="month", place={"latitude": 6.25})
    assert sorted(len(r.daily.time) for r in docs.collect()) == [1, 2]
    assert docs.schema.simpleString() == WEATHER_DOCUMENT.simpleString()
    assert Counter(map(tuple, unpack_days(docs).collect())) == Counter(rows)
    with pytest.raises(Exception, match="more than one row for 2022-01-01"):
        pack_documents(days.unionAll(days.limit(1))).collect()


def extract(spark, *rows):
    return spark.createDataFrame(list(rows), INCIDENT_EXTRACT)


def test_typed_incidents_edge_rows(spark):
    rows = typed_incidents(
        extract(
            spark,
            ("1", "M", "12", "Bajo", "2022-01-01"),
            ("2", "M", "abc", None, "2022-01-02"),
            ("3", "M", None, "bajo", "nope"),
            ("4", "M", "7.0", "Otro", None),
        ),
        SETTINGS,
    )
    assert rows.columns == ["id", "city", "reported_incidents", "date", "congestion_level_num"]
    assert sorted(map(tuple, rows.collect())) == [
        ("1", "M", 12, date(2022, 1, 1), 1),
        ("2", "M", None, date(2022, 1, 2), 3),
        ("3", "M", None, None, 3),
        ("4", "M", 7, None, 3),
    ]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_trusted_rows(spark, limit):
    days = spark.createDataFrame(
        [
            (date(2022, 1, 1), 20.0, 0.0),
            (date(2022, 1, 2), 21.0, None),
            (date(2022, 1, 2), 22.0, 3.0),
            (date(2022, 1, 7), 25.0, 1.0),
            (None, 26.0, 1.0),
        ],
        WEATHER_DAYS,
    )
    trusted = build_trusted(
        days,
        extract(
            spark,
            ("1", "M", "12", "Bajo", "2022-01-01"),
            ("2", "M", "9", "Medio", "2022-01-02"),
            ("3", "M", "8", "Alto", "2022-01-03"),
            ("4", "M", "8", "Alto", None),
        ),
        Settings(broadcast_max_bytes=limit),
    )
    assert trusted.columns == TRUSTED.fieldNames()
    assert [f.dataType for f in trusted.schema] == [f.dataType for f in TRUSTED]
    assert sorted(map(tuple, trusted.collect())) == [
        (date(2022, 1, 1), "1", "M", 12, 20.0, 0.0, 1),
        (date(2022, 1, 2), "2", "M", 9, 21.0, None, 2),
        (date(2022, 1, 2), "2", "M", 9, 22.0, 3.0, 2),
    ]
    plan = trusted._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (limit == 0)
    assert ("BroadcastHashJoin" in plan) == (limit > 0)


def test_join_on_more_than_the_date(spark):
    days = spark.createDataFrame(
        [(date(2022, 1, 1), "M", 20.0, 0.0), (date(2022, 1, 1), "B", 10.0, 1.0)],
        "date date, city string, max_temp double, precipitation double",
    )
    trusted = build_trusted(
        days,
        extract(spark, ("1", "B", "5", "Alto", "2022-01-01")),
        Settings(join_keys=("date", "city")),
    )
    assert [tuple(r) for r in trusted.collect()] == [(date(2022, 1, 1), "1", "B", 5, 10.0, 1.0, 3)]


def skewed_facts(spark, n=20_000):
    """A third of the rows on one key, and a third of those are copies of one row."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    value = F.when(F.col("id") % 9 == 0, F.lit(-1)).otherwise(F.col("id"))
    return spark.range(n).select(
        F.when(F.col("id") % 1000 != 1, key).cast("int").alias("k"), value.alias("v")
    )


@pytest.mark.parametrize("fan_out", [1, 64])
def test_sliced_join_equals_the_plain_join(spark, fan_out):
    facts = skewed_facts(spark)
    other = spark.range(1500).select(
        (F.col("id") % 1100).cast("int").alias("k"), (F.col("id") * 2).alias("w")
    )
    want = facts.join(other, "k", "inner")
    got = sliced_join(facts, other, ["k"], fan_out)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_hot_keys_and_copies_are_spread(spark):
    """Rows of one key and copies of one row end up in several shuffle partitions."""
    facts = spark.range(40_000, numPartitions=40).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"),
    )
    other = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    joined = sliced_join(facts, other, ["k"], 64)
    assert joined.count() == 40_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = joined.where("k = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in hot) == 13_334
    assert len(hot) > 3


def test_a_join_without_hot_keys_is_not_sliced(spark):
    facts = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = sliced_join(facts, facts.select("k", F.lit(2).alias("w")), ["k"])
    assert "_slice" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 5000


def test_measured_bytes_grows_with_rows_and_texts(spark):
    short = spark.createDataFrame([("a",)] * 10, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "s string")
    assert measured_bytes(long) - measured_bytes(short) == 9990
    assert measured_bytes(short.unionAll(short)) == 2 * measured_bytes(short)
    assert measured_bytes(spark.createDataFrame([([1],)], "a array<int>")) is None
    assert measured_bytes(short.where("s = 'z'")) == 0


def test_stage_counts_equal_counting_each_stage(spark):
    rng = random.Random(3)
    days = spark.createDataFrame(
        [(None if rng.random() < 0.1 else date(2022, 1, rng.randint(1, 20)), 1.0, 1.0) for _ in range(60)],
        WEATHER_DAYS,
    )
    incidents = typed_incidents(
        extract(
            spark,
            *(
                (str(i), "M", "1", "Alto", rng.choice([None, "bad", f"2022-01-{rng.randint(10, 31)}"]))
                for i in range(200)
            ),
        ),
        SETTINGS,
    )
    docs = spark.createDataFrame([(None,) * 9] * 4, WEATHER_DOCUMENT)
    got = {r.stage: r.n_rows for r in stage_counts(docs, days, incidents, "date").collect()}
    assert got == {
        "weather_documents": 4,
        "weather_days": 60,
        "incident_rows": 200,
        "joined_rows": incidents.join(days, "date").count(),
    }
    empty = stage_counts(docs.limit(0), days.limit(0), incidents.limit(0), "date").collect()
    assert {r.n_rows for r in empty} == {0}


def test_extract_round_trip_keeps_texts(spark, tmp_path):
    rows = [
        ("1", 'say "x", y', "3", "Alto", "2022-01-01"),
        ("2", "back\\slash", None, "Medellín", "2022-01-02"),
        ("3", "", "4", "a;b", "2022-01-03"),
    ]
    path = str(tmp_path / "extract")
    land_extract(extract(spark, *rows), path)
    # Files hold one form for the empty and the missing text.
    rows[2] = ("3", None, "4", "a;b", "2022-01-03")
    assert sorted(map(tuple, read_extract(spark, path).collect())) == rows


def test_extract_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city,incident_date,congestion_level,reported_incidents\n1,M,2022-01-01,Alto,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, str(tmp_path)).collect()


def test_landing_twice_overwrites(spark, tmp_path):
    path = str(tmp_path / "extract")
    for _ in range(2):
        land_extract(extract(spark, ("1", "M", "3", "Alto", "2022-01-01")), path)
    assert read_extract(spark, path).count() == 1


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.usefixtures("no_coalescing")
@pytest.mark.parametrize("hot", ["facts", "other", "both"])
def test_a_hot_key_of_either_side_is_cut(spark, hot):
    n_facts, n_other = {"facts": (4000, 3), "other": (3, 4000), "both": (400, 400)}[hot]
    facts = spark.range(n_facts).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    other = spark.range(n_other).select(F.lit("k").alias("k"), F.col("id").alias("w"))
    joined = sliced_join(facts, other, ["k"], rows_per_task=100)
    parts = joined.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in parts) == n_facts * n_other
    assert len(parts) > 2
    assert joined.select("v", "w").distinct().count() == n_facts * n_other


@pytest.mark.usefixtures("no_coalescing")
def test_equal_keys_above_the_target_are_cut_too(spark):
    facts = spark.range(4000).select((F.col("id") % 4).alias("k"), "id")
    joined = sliced_join(facts, spark.range(4).select(F.col("id").alias("k")), ["k"], rows_per_task=200)
    places = joined.select("k", F.spark_partition_id().alias("p"))
    per_key = places.groupBy("k").agg(F.count_distinct("p").alias("parts")).collect()
    assert all(r.parts > 1 for r in per_key) and joined.count() == 4000


def test_documents_of_several_places(spark):
    rows = [(1.0, 5.0, date(2022, 1, 1), 20.0, 0.0), (2.0, 5.0, date(2022, 1, 1), 21.0, 1.0), (2.0, 5.0, date(2022, 1, 2), 22.0, 2.0)]
    days = spark.createDataFrame(rows, "latitude double, longitude double, date date, max_temp double, precipitation double")
    docs = pack_documents(days, by=("latitude", "longitude")).collect()
    assert sorted((d.latitude, d.longitude, list(d.daily.temperature_2m_max)) for d in docs) == [
        (1.0, 5.0, [20.0]), (2.0, 5.0, [21.0, 22.0])
    ]
    with pytest.raises(Exception, match="more than one row"):
        pack_documents(days).select("daily.time").collect()
