import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rainlane.llm import prefix_trie
from rainlane.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, p string"


def brute(convs):
    """conv -> list of (role, text); rows of all prefixes by dictionaries."""
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {}
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    rows = set()
    for key, own in members.items():
        below = [k for k in members if k[: len(key)] == key]
        ends = sorted(c for c in own if len(convs[c]) == len(key))
        rows.add((
            min(own), len(key), min(members[key[:-1]]) if key else None, len(own), len(kids.get(key, ())),
            sum(k not in kids for k in below),
            sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return rows


def rows_of(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    found = [tuple(r[name] for name in names) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def made(seed, n=120, deep=9, words=2):
    """Conversations that share beginnings, with chains, ends in the middle and copies."""
    pick = random.Random(seed)
    convs = {}
    for conv in pick.sample(range(-50, 5000), n):
        turns = list(convs[pick.choice(list(convs))]) if convs and pick.random() < 0.7 else []
        turns = turns[: pick.randint(0, len(turns))]
        while len(turns) < deep and pick.random() < 0.75:
            turns.append((pick.choice(["user", "assistant"]), "w" * pick.randint(0, words)))
        convs[conv] = turns
    return {conv: turns for conv, turns in convs.items() if turns}


def frame_of(spark, convs):
    rows = [(c, i, role, text, "x", None) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("options", [{}, {"most_turns": 3}, {"broadcast_nodes": 0, "batches": (1, 1, 1, 1)}])
def test_against_brute_force(spark, options):
    convs = made(len(options))
    assert rows_of(prefix_trie.prefix_nodes(frame_of(spark, convs), **options)) == brute(convs)


def test_one_long_and_many_equal(spark):
    """A conversation with most rows lies in many parts; copies end in one node."""
    long = [("user", str(i % 7)) for i in range(300)]
    convs = {1: long, 2: long[:150], 3: [*long[:299], ("user", "other")]}
    convs |= {c: [("user", "hello"), ("assistant", "hi")] for c in range(10, 120)}
    convs |= {c: [("user", "hello"), ("assistant", str(c))] for c in range(200, 230)}
    for options in ({}, {"most_turns": 100}):
        assert rows_of(prefix_trie.prefix_nodes(frame_of(spark, convs), **options)) == brute(convs)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    found = frame.select("a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    assert all(r.f == max(range(r.a + 1, r.b + 1), key=lambda n: n & -n) for r in found)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "left out", None, None), (5, None, None, None, None, None), (5, 0, "", "", None, None),
        (5, 0, "user", "b", None, None), (5, 0, "user", "b", None, None), (6, 3, None, None, None, None),
        (7, 1, "user", "long " * 200_000, None, None), (8, -1, "user:", "x", None, None), (9, 1, "user", ":x", None, None),
    ]
    found = rows_of(prefix_trie.prefix_nodes(spark.createDataFrame(rows, SCHEMA)))
    ties = sorted([("", ""), ("user", "b"), ("user", "b")], key=lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest())
    convs = {5: [("", ""), *ties], 6: [("", "")], 7: [("user", "long " * 200_000)], 8: [("user:", "x")], 9: [("user", ":x")]}
    assert found == brute(convs)
    empty = prefix_trie.prefix_nodes(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.schema["ends_sha256"].dataType.simpleString() == "string"


def test_query_rebuilds_conversations(spark, tmp_path):
    convs = made(5, n=150)
    convs |= {100: convs[min(convs)], 200: [("user", "a")]}
    frame_of(spark, convs).write.parquet(f"{tmp_path}/conversations.parquet")
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = [*convs.get(base, [])[:h], *turns[h:]]
    assert any(not turns for turns in rebuilt.values())
    assert rows_of(QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == brute(rebuilt)
