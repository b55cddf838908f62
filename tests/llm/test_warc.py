import base64
import hashlib

import pytest

from rainlane.llm.warc import archive_round_trip, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, tag string"
ROWS = [
    (3, "http://a/3", "<p>x</p>", "t"), (1, "http://a/1", "<p>x</p>", None), (2, None, None, None),
    (4, "http://a/4", "", "t"), (5, "bad\r\nX: y", "é\r\n\r\nWARC/1.1\r\n\r\n", "t"), (6, "", "z" * 3_000_000, "t"),
    (None, "http://a/n", "<p>x</p>", "t"), (1, "http://a/1", "<p>x</p>", None), (7, "u", "only", "t"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_round_trip_and_revisits(from_files):
    got = archive_round_trip(from_files(ROWS, SCHEMA)).collect()
    assert len(got) == len(ROWS)
    want = {}
    for key, _, html, _ in ROWS:
        want.setdefault(html or "", []).append(key)
    rows = []
    for payload, keys in want.items():
        keys.sort(key=lambda k: (k is None, k))
        for at, key in enumerate(keys):
            first = None if not at else str(keys[0])
            name = None if key is None else str(key)
            rows.append((name, "revisit" if at else "response", digest(payload), len(payload.encode()), first))
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_small_payloads_are_never_revisits(from_files):
    pages = from_files(ROWS, SCHEMA)
    got = archive_round_trip(pages, min_bytes=1).collect()
    assert sum(r.type == "revisit" for r in got) == 3
    assert sum(r.type == "response" and r.payload_bytes == 0 for r in got) == 2


def test_archives_are_checked_when_read(spark, from_files, tmp_path):
    path = tmp_path / "archives"
    write_archives(from_files(ROWS[:2], SCHEMA, files=1), str(path))
    [file] = path.glob("part-*")
    content = file.read_bytes()
    assert content.startswith(b"WARC/1.1\r\nWARC-Type: ") and content.endswith(b"\r\n\r\n")
    assert b"WARC-Refers-To-Target-URI: http://a/1" in content
    other = tmp_path / "broken"
    other.mkdir()
    (other / file.name).write_bytes(content.replace(b"<p>x</p>", b"<p>y</p>"))
    with pytest.raises(Exception, match="another digest"):
        read_archives(spark, str(other)).collect()


def test_empty_table(from_files):
    assert archive_round_trip(from_files([], SCHEMA)).collect() == []


def test_files_are_bounded_by_bytes(spark, from_files, tmp_path):
    rows = [(i, f"http://a/{i}", "x" * (40_000 if i % 10 == 0 else 20) + str(i)) for i in range(60)]
    pages = from_files(rows, "page_id long, url string, html string", files=1)
    path = str(tmp_path / "archives")
    write_archives(pages, path, file_bytes=100_000, records_per_file=50)
    sizes = [p.stat().st_size for p in (tmp_path / "archives").glob("part-*")]
    assert sum(sizes) > 240_000 and max(sizes) < 130_000
    found = read_archives(spark, path).collect()
    assert sorted(int(r.source_id) for r in found) == list(range(60))
