import random

import numpy as np
import pytest

from rainlane.llm.cuckoo import CuckooFilter, Full
from rainlane.llm.line_dedup import LineIndex, drop_repeated_lines, shards_for

SCHEMA = "doc_id long, text string, shard string, keys string, n string"
BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, points=40, documents=5):
    def key(line):
        bare = line.strip(BLANKS)
        return "".join(c.lower() if c.isascii() else c for c in bare)

    order = {None: -1}
    holders = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= points:
                holders.setdefault(key(line), set()).add(doc)
    last = {k: max(own, key=lambda d: order.get(d, d)) for k, own in holders.items() if len(own) >= documents}
    result = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), doc) == doc]
        result.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=str)


def cleaned(frame):
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    common = [f"line {k} " + "Äb c" * 12 for k in range(6)] + ["short line"]
    rows = []
    for doc in range(60):
        lines = [f"own {doc} {rng.random()} " + "x" * 40]
        for k, line in enumerate(common):
            if doc % (k + 2) == 0:
                lines += [f"  {line.swapcase() if doc % 4 == 0 and line.isascii() else line}\t\r"] * (1 + doc % 2)
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines), "s", None, "n"))
    hot = "The same line in all the documents of this group, again"
    rows += [(doc, f"{hot}\n\n{hot.upper()}", None, "k", "n") for doc in range(100, 140)]
    rows += [(None, hot, "s", None, None), (140, None, "s", "k", "n"), (141, "", None, None, None), (3, hot, "s", "k", "n")]
    rows += [(142, "é" * 39, "s", "k", "n"), (143, "é" * 40 + "\n" * 5000, "s", "k", "n")]
    return rows


def test_against_brute_force_and_reversible(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = LineIndex(spark, shards=4)
    first, rest = docs.where("doc_id < 120"), docs.where("doc_id is null or doc_id >= 120")
    index.insert(first)
    early = [r for r in rows if r[0] is not None and r[0] < 120]
    assert cleaned(index.clean(first)) == brute(early)
    index.insert(rest)
    assert cleaned(index.clean(docs)) == brute(rows)
    filters = index.filters()
    assert filters.count() <= 4
    again = LineIndex(spark, index.folder, index.version, shards=4)
    again.delete(rest.select("doc_id"))
    assert cleaned(again.clean(first)) == brute(early)


def test_without_room_for_filters(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert cleaned(drop_repeated_lines(docs, filter_bytes=0)) == brute(rows)


def test_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cuckoo_filter():
    rng = np.random.default_rng(7)
    hashes = rng.integers(-(2**63), 2**63 - 1, 3000)
    own = CuckooFilter.of(hashes[:2000])
    assert own.contains(hashes[:2000]).all()
    assert own.contains(hashes[2000:]).mean() < 0.01
    own.delete(hashes[:1000])
    assert CuckooFilter.from_bytes(own.to_bytes()).contains(hashes[1000:2000]).all()
    assert own.contains(hashes[:1000]).mean() < 0.01
    with pytest.raises(KeyError):
        CuckooFilter.for_count(10).delete(hashes[:1])
    with pytest.raises(Full):
        CuckooFilter.for_count(4).insert(hashes[:50])


def test_shards_follow_from_the_size(spark):
    docs = spark.createDataFrame([("x" * 1000,), (None,)], "text string")
    assert shards_for(docs, "text", 40, 5) == shards_for(docs.where("text is null"), "text", 40, 5) == 64
    assert shards_for(spark.range(100).selectExpr("repeat('x', 1000000) AS text"), "text", 1, 1) == 100
