import pytest
from pyspark.sql import functions as F

from rainlane.llm.exact_dedup import StreamingDedup, drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, digest string, _metadata string"


def brute(rows):
    """(id, text) -> keep id, group size."""
    groups = {}
    for key, text, *_ in rows:
        bare = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(bare, []).append((-len(text or ""), float("inf") if key is None else key, key))
    return {
        (key, size, len(own), min(own, key=lambda x: x[:2])[2])
        for own in groups.values()
        for size, _, key in own
    }


ROWS = [
    (1, "a b", "x", None), (2, "ab", None, "m"), (3, "a  b ", "x", "m"), (4, None, "x", None),
    (5, "", None, None), (6, " \n", "x", None), (7, "A b", "x", None), (None, "é é", "x", None),
    (8, "éé", "x", None), (9, "w " * 50_000, "x", None), (10, "w" * 50_000, "x", None), (11, " ab", "x", None),
    (1, "a b", "y", None), (12, "tie", None, None), (13, "tie", None, None),
]


def decided(rows):
    return {(r.id, r.keep_id, r.group_size, r.kept) for r in rows.collect()}


@pytest.mark.parametrize("digest", [None, lambda text: F.substring(F.sha2(text, 256), 1, 1)])
def test_arrivals_against_brute_force(spark, from_files, digest):
    """The second digest has 16 values, so different texts meet and are told apart."""
    docs = from_files(ROWS, SCHEMA)
    dedup = StreamingDedup(spark, **({"digest": digest} if digest else {}))
    dedup.add(docs)
    found = dedup.decisions(docs)
    assert found.count() == len(ROWS)
    assert {(r.id, r.group_size, r.keep_id) for r in found.collect()} == {(k, n, keep) for k, _, n, keep in brute(ROWS)}
    per_group = found.where("kept").count()
    assert per_group == len({"".join((t or "").split(" ")).replace("\n", "") for _, t, *_ in ROWS})


def test_state_outlives_the_object(spark, from_files):
    first = from_files([(5, "same text", "", ""), (6, "other", "", "")], SCHEMA)
    dedup = StreamingDedup(spark)
    dedup.add(first)
    again = StreamingDedup(spark, dedup.folder)
    second = from_files([(1, "sametext", "", ""), (7, "same  text", "", "")], SCHEMA)
    again.add(second)
    assert decided(again.state().select(F.lit(0).alias("id"), "keep_id", F.col("n").alias("group_size"), F.lit(True).alias("kept"))) == {
        (0, 7, 3, True), (0, 6, 1, True)
    }


def test_drop_copies_keeps_all_columns_and_empty_tables(from_files):
    docs = from_files(ROWS, SCHEMA)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 99 for r in left.collect()) == [3, 6, 7, 9, 11, 12, 99]
    assert exact_dedup(from_files([], SCHEMA)).collect() == []


def test_only_texts_of_hits_are_compared(spark, from_files):
    """By bitmaps, also where each part of the files has its own; of 90 rows 30 are hits."""
    rows = [(i, f"text {i if i < 60 else i % 15}", "", "") for i in range(90)]
    docs = from_files(rows, SCHEMA, files=7)
    for at_once in (8192, 2):
        dedup = StreamingDedup(spark, bitmaps_at_once=at_once)
        dedup.add(docs)
        hits = dedup.rows().join(dedup.state().where("n > 1"), "digest")
        assert dedup._texts_of(hits, docs, "text").count() == hits.count() == 45
        found = dedup.decisions(docs)
        assert {(r.id, r.group_size, r.keep_id) for r in found.collect()} == {(k, n, keep) for k, _, n, keep in brute(rows)}


def test_parts_of_the_files_are_scanned_once(spark, from_files):
    docs = from_files([(i, str(i), "", "") for i in range(30)], SCHEMA, files=5)
    part = docs.where(F.pmod(F.xxhash64(docs.metadataColumn("_metadata").getField("file_path")), F.lit(3)) == 1)
    part.collect()
    scans = part._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.apply(0).metrics().apply("numFiles").value() < 5
