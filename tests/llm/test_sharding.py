import random

import pytest
from pyspark.sql import functions as F

from rainlane.llm.sharding import count_below, find_splitters, shard_by_bytes

SCHEMA = "doc_id long, text string, shard int, size string"


def check(rows, placed, shards):
    assert len(placed) == len(rows)
    slots, sizes = {}, [0] * shards
    for r in placed:
        assert r.size == len((r.row.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    return sizes


@pytest.mark.parametrize("range_bytes", [64 << 20, 2_000])
def test_hot_text_is_cut_and_bytes_are_equal(spark, range_bytes):
    rng = random.Random(5)
    rows = [(i, "hot text " * 5 if i % 3 == 0 else "w" * rng.randrange(80), 1, "s") for i in range(3000)]
    rows += [(None, None, None, None), (None, "", 1, "s"), (7, "hot text " * 5, None, "s")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    placed = shard_by_bytes(docs, shards=8, range_bytes=range_bytes).collect()
    sizes = check(rows, placed, 8)
    assert max(sizes) - min(sizes) <= 200
    texts = {}
    for r in placed:
        texts.setdefault(r.row.text, set()).add(r.shard)
    short = [own for text, own in texts.items() if text and not text.startswith("hot")]
    assert sum(len(own) > 1 for own in short) <= 7


def test_a_task_has_one_range_and_rows_move_once(spark):
    docs = spark.createDataFrame([(i, "w" * (i % 50), 1, "s") for i in range(4000)], SCHEMA).repartition(4)
    placed = shard_by_bytes(docs, shards=8, range_bytes=2_000).select("shard", "slot")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange" in line and "RoundRobin" not in line]
    assert len(moves) == 1
    tasks = placed.groupBy(F.spark_partition_id().alias("task"), "shard").agg(
        F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n")
    ).collect()
    assert len({r.task for r in tasks}) == len(tasks) > 40
    assert all(r.high - r.low + 1 == r.n for r in tasks)


def test_few_repeated_and_no_rows(spark):
    rows = [(1, "same", 1, "a")] * 5 + [(2, "x" * 100_000, 1, "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    check(rows, shard_by_bytes(docs).collect(), 8)
    assert shard_by_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_are_exact(spark):
    rows = [(k % 7, k, 1 + k % 5) for k in range(500)]
    frame = spark.createDataFrame(rows, "key long, tie long, size long").repartition(3)
    bounds = [(0, 10), (2, 0), (3, 100), (3, 101), (6, 400)]
    sizes, counts = count_below(frame, bounds)
    for i, bound in enumerate(bounds):
        assert sizes[i] == sum(s for k, t, s in rows if (k, t) < bound)
        assert counts[i] == sum((k, t) < bound for k, t, _ in rows)
    assert (sizes[-1], counts[-1]) == (sum(r[2] for r in rows), 500)
    splitters = find_splitters(frame, 4, 1, 0.01)
    below = [sum(s for k, t, s in rows if (k, t) < b) for b in splitters]
    assert all(abs(got - sizes[-1] * (i + 1) / 4) <= 5 for i, got in enumerate(below))
