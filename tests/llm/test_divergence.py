import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rainlane.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, r string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda own: own[0].lower(), text or ""))


def brute(rows, least_docs, most_terms):
    counts, has, groups = {}, {}, {}
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        own = terms(text)
        counts.setdefault((lang, source), Counter()).update(own)
        has.setdefault(lang, Counter()).update(set(own))
    found = set()
    for lang, sources in groups.items():
        kept = [t for t, n in has[lang].items() if n >= least_docs]

        def price(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = price(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: price(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in sources if o != s]
            raised = [(own[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, values, most in (("pair", pairs, None), ("term", raised, most_terms)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                found |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(values[:most], 1)}
    return found


def rows_of(frame):
    found = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def made(seed, n, sources, vocabulary, langs=("en", "fr", None)):
    """Sources with words of their own among common ones; languages of different sizes."""
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdeéßあ") for _ in range(pick.randint(1, 6))) for _ in range(vocabulary)]
    rows = []
    for k in range(n):
        source = pick.randrange(sources)
        own = words[source * 7 % vocabulary :][:30]
        text = "".join(pick.choice([*words[:20], *own, *words]) + pick.choice([" ", "-", ", ", "\n", "9", "_"]) for _ in range(pick.randint(0, 40)))
        rows.append((k, pick.choice([text, text.upper(), text]), pick.choice(langs), pick.choice([f"s{source}", f"s{source}", "S", None]), "x", 1, None))
    return rows


@pytest.mark.parametrize("seed,n,sources,vocabulary,least", [(0, 400, 5, 60, 3), (1, 900, 70, 700, 2), (2, 300, 40, 30, 30)])
def test_against_brute_force(spark, seed, n, sources, vocabulary, least):
    rows = made(seed, n, sources, vocabulary)
    found = rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA), least, 4))
    assert found == brute(rows, least, 4)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None, None, None), (2, "", "en", "a", None, None, None), (3, "12 _ @[`{", "en", "b", None, None, None),
        (4, "word WORD Été été " * 5, "en", "c", None, None, None), (5, "word", "en", "c", None, None, None),
        (5, "word", "en", "c", None, None, None), (6, "long " * 1_500_000 + "word", "de", "x", None, None, None),
        (7, "あ" * 300_000, "de", "y", None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for least in (1, 2, 3, 4):
        assert rows_of(divergence.audit(docs, least, 50)) == brute(rows, least, 50)
    assert divergence.audit(docs.where("doc_id < 0")).collect() == []


def test_terms_of_a_long_text_are_whole(monkeypatch):
    text = "Ab-cde é" * 50
    monkeypatch.setattr(divergence, "SLICE", 7)
    assert [t.decode() for own in divergence.terms_of(text.encode()) for t in own] == terms(text)


def test_tables_of_tasks_are_flushed(spark, monkeypatch):
    rows = made(3, 200, 4, 300)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", 50)
    monkeypatch.setattr(divergence, "MOST_PAIRS", 1)
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA), 2, 50)) == brute(rows, 2, 50)


def test_large_counts(spark):
    values = [(n, total) for n in (0, 1, 10**6, 10**12, 8 * 10**15) for total in (n + 5, 2 * n + 77, 9 * 10**15) if n + 5 <= total <= 9 * 10**15]
    frame = divergence.with_price(spark.createDataFrame(values, "n long, total long"), F.col("n"), F.col("total"), "p")
    assert all(r.p == 1 + 10**9 * (r.n + 5) // r.total for r in frame.collect())


def test_zero_squares_are_left_out(spark):
    """Two blocks of sources without a common term: the traversal ends above the leaves."""
    rows = [(k, f"{chr(97 + k % 4)}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} " * 2, "en", f"s{k % 4}", None, None, None) for k in range(2600)]
    matrix = divergence.TermMatrix(spark.createDataFrame(rows, SCHEMA), 1)
    leaves = divergence.leaves_of(matrix.cells)
    assert leaves.agg(F.max(F.size("cells"))).first()[0] <= divergence.LEAF**2
    squares = divergence.squares_of(leaves, 4)
    langs = spark.createDataFrame([("en", 3, 200, 3200)], "lang string, blocks long, stripes long, terms long")
    ends = {(r.a, r.b, r.j) for r in divergence.common_leaves(squares, langs, 4).collect()}
    have = {(r.i, r.j) for r in leaves.collect()}
    assert ends == {(a, b, j) for a in range(3) for b in range(a, 3) for j in range(200) if (a, j) in have or (b, j) in have}
    assert len(ends) < 6 * 200
