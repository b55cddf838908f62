import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rainlane.llm.packing import SumOfSquares, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string"


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def check_pieces(rows, texts_by_id, window=1024):
    """Each id of each document once, in order, and no holes in a sequence."""
    want = {k: whole_ids([t])[0] for k, t in texts_by_id.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == want.keys()
    for key, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[key])
            ids = np.array(want[key][at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(ids.tobytes())
            assert r.ids == list(ids)
            at += r.length
        assert at == len(want[key])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return sequences


CASES = [
    "", None, "one", " lead", "trail ", "two  blanks", "a   b\n\n c \t d   e", "\n\n", "It's we'll  x",
    "<|endoftext|> and <|endoftext|>", "日本語のテキスト。 émentréch être\r\n zwei", "word " * 5000, "x" * 30000,
    "tab\tand \nline \n\n next", " ", "  ", "   ", "a ", "emoji 👍🏽 done",
]


def test_round_trip_of_odd_texts(from_files):
    docs = from_files([(i, t, "s") for i, t in enumerate(CASES)], SCHEMA)
    check_pieces(pack(docs, PATH).collect(), dict(enumerate(CASES)))


def test_whole_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sequences = check_pieces(pack(docs.repartition(3), PATH).collect(), texts)
    short = [s for s in sequences.values() if sum(r.length for r in s) < 1024]
    assert len(short) <= 3


def test_repeated_and_null_ids_and_text_ids(spark):
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "c")], "doc_id long, text string")
    assert sorted((r.id or -1, r.length) for r in pack(rows, PATH).collect()) == [(-1, 3), (-1, 3), (7, 2)]
    named = spark.createDataFrame([("k", "a b")], "doc_id string, text string")
    assert [r.id for r in pack(named, PATH).collect()] == ["k"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pack(docs, PATH, with_ids=False).collect() == []
    assert "ids" not in pack(docs, PATH, with_ids=False).columns


@pytest.mark.parametrize("seed", range(5))
def test_level_is_the_one_of_least_squares(seed):
    rng, levels = np.random.default_rng(seed), SumOfSquares(20)
    for _ in range(300):
        size = int(rng.integers(1, 20))
        before = levels.counts.copy()

        def squares(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 20:
                after[level + size] += 1
            return (after**2).sum()

        allowed = [h for h in range(20 - size + 1) if h == 0 or before[h]]
        assert squares(levels.level_for(size)) == min(map(squares, allowed))
        levels.place(("k", size), size)
        assert levels.counts.tolist() == [0, *map(len, levels.open[1:]), 0]
