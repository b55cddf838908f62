import hashlib

import numpy as np
from pyspark.sql import functions as F

from rainlane.llm.mixing import Tempered, calibrate, draw, drawn, keyword_topic, meet, mix, n_words, rake, text_margins
from rainlane.llm.queries import TARGETS as REGISTERED

def brute(rows, targets):
    """A plain rake over a dictionary of cells: (cell of each row, probability of each row).
    ``rows`` are (tokens, value of each margin)."""
    def cell_of(values):
        return tuple(
            v if v is not None and (isinstance(own, Tempered) or v in own) else "other"
            for v, own in zip(values, targets.values())
        )

    cells = [cell_of(values) for _, *values in rows]
    counted = {}
    for (tokens, *_), cell in zip(rows, cells):
        counted[cell] = counted.get(cell, 0) + tokens
    whole = sum(counted.values())

    def margin(weights, axis):
        found = {}
        for cell, weight in weights.items():
            found[cell[axis]] = found.get(cell[axis], 0) + weight
        return found

    goals = []
    for axis, own in enumerate(targets.values()):
        have = margin(counted, axis)
        if isinstance(own, Tempered):
            top = max(have.values())
            wanted = {v: n / top * min((n / top) ** (own.power - 1), own.most) for v, n in have.items()}
        else:
            wanted, left = dict(own), 1 - sum(own.values())
            if left < 1e-9:
                left = have.get("other", 0) / whole
                wanted = {v: share * (1 - left) / sum(own.values()) for v, share in own.items()}
            wanted.setdefault("other", left)
        wanted = {v: wanted[v] for v in have}
        goals.append({v: share / sum(wanted.values()) for v, share in wanted.items()})
    for part in (0, 0.25, 0.5, 0.75, 1):
        weights = {cell: n / whole for cell, n in counted.items()}
        nearer = [
            {v: (1 - part) * share + part * margin(weights, axis)[v] for v, share in goal.items()}
            for axis, goal in enumerate(goals)
        ]
        for _ in range(1000):
            for axis, goal in enumerate(nearer):
                now = margin(weights, axis)
                weights = {c: w * goal[c[axis]] / now[c[axis]] if now[c[axis]] else 0 for c, w in weights.items()}
        if all(abs(margin(weights, a)[v] - share) < 1e-6 for a, goal in enumerate(nearer) for v, share in goal.items()):
            break
    raised = {cell: weights[cell] / n for cell, n in counted.items()}
    return [raised[cell] / max(raised.values()) for cell in cells]


def words_of(text):
    return max(1, len((text or "").strip(" ").split()))


def topic_of(text, topics=8):
    counts = {}
    for word in (text or "").lower().split():
        counts[word] = counts.get(word, 0) + 1
    long = [w for w in counts if len(w) >= 5]
    best = min(long, key=lambda w: (-counts[w], w), default="")
    digest = hashlib.blake2b(best.encode(), digest_size=8).digest()
    return f"topic{int.from_bytes(digest, 'little') % topics}"


def check_against_brute(docs, targets):
    """Probabilities by ``brute``, and documents kept by the draw that their identifier decides."""
    rows = docs.select("doc_id", "text", "source", "lang", draw(F.col("doc_id")).alias("draw")).collect()
    measured = [(words_of(r.text), r.source, r.lang, topic_of(r.text)) for r in rows]
    wanted = {r.doc_id: (r.draw, p) for r, p in zip(rows, brute(measured, targets))}
    mixed = mix(docs, n_words(), text_margins(), targets).select("row.doc_id", "probability", "kept").collect()
    assert len(mixed) == len(rows)
    for r in mixed:
        at, p = wanted[r.doc_id]
        assert abs(r.probability - p) < 1e-6
        assert abs(at - p) < 1e-6 or r.kept == (at < p)
    return {r.doc_id for r in mixed if r.kept}


SCHEMA = "doc_id long, text string, lang string, source string, tokens string, kept string"
TARGETS = {"source": {"a": 0.5, "b": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"topic0": 0.5, "topic1": 0.5}}


def docs_of(spark, n=3000):
    rng = np.random.default_rng(0)
    rows = [
        (i, "word" * int(rng.integers(1, 3)) + " filler" * int(rng.integers(1, 60)) + f" keyword{i % 50}" * 61, str(rng.choice(["en", "de"])), str(rng.choice(["a", "b", "c", "d"])), "t", None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_rake_keeps_ratios_and_meets_margins():
    rng = np.random.default_rng(1)
    totals = rng.uniform(1, 9, (3, 2, 4))
    goals = [np.array([0.2, 0.3, 0.5]), np.array([0.6, 0.4]), np.array([0.25] * 4)]
    found = rake(totals, goals)
    for axis, goal in enumerate(goals):
        rest = tuple(a for a in range(3) if a != axis)
        assert np.allclose(found.sum(axis=rest), goal)
    ratio = np.log(found / totals)
    odds = ratio[1:, 1:, 1:] - ratio[:-1, 1:, 1:] - ratio[1:, :-1, 1:] + ratio[:-1, :-1, 1:]
    assert np.allclose(odds, 0)  # a product of one factor per margin


def test_rake_with_holes():
    totals = np.array([[5.0, 0.0], [0.0, 0.0]])
    assert np.allclose(rake(totals, [np.array([0.5, 0.5]), np.array([0.5, 0.5])]), [[1, 0], [0, 0]])
    assert rake(np.zeros((2, 2)), [np.array([0.5, 0.5])] * 2).sum() == 0
    crossed = np.array([[5.0, 0.0], [0.0, 3.0]])
    assert np.isfinite(rake(crossed, [np.array([0.5, 0.5]), np.array([0.9, 0.1])])).all()


def test_probabilities_meet_the_targets(spark):
    docs = docs_of(spark)
    found = mix(docs, n_words(), text_margins(topics=2), TARGETS)
    whole = found.toPandas()
    weight = whole["tokens"] * whole["probability"]
    for name, own in TARGETS.items():
        share = weight.groupby(whole[name]).sum() / weight.sum()
        for value, goal in own.items():
            assert abs(share[value] - goal) < 1e-6
    assert whole["probability"].max() == 1 and len(whole) == 3000
    assert abs(whole["kept"].mean() - whole["probability"].mean()) < 0.03
    again = mix(docs.repartition(7), n_words(), text_margins(topics=2), TARGETS)
    assert again.where("kept").count() == int(whole["kept"].sum())


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, None), (None, "", "xx", "", "t", "k"), (1, "long " * 100_000, "en", "a", "t", "k"), (1, "a", "de", "b", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = calibrate(docs, n_words(), text_margins(), TARGETS).collect()
    assert sorted(r.tokens for r in found) == [1, 1, 1, 100_000]
    assert all(0 <= r.probability <= 1 for r in found)
    assert {(r.lang, r.source) for r in found} == {("other", "other"), ("en", "a"), ("de", "b")}
    empty = docs.where("doc_id < 0")
    assert mix(empty, n_words(), text_margins(), TARGETS).collect() == []


def test_topic_is_the_keyword(spark):
    texts = ["apple apple other", "other APPLE Apple", None, "a b c"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    topics = [r[0] for r in frame.select(keyword_topic(1000)(F.col("text"))).collect()]
    assert topics[0] == topics[1] != topics[2] == topics[3]


def test_unnamed_and_null_languages_can_be_kept(spark):
    docs = docs_of(spark).withColumn("lang", F.expr("CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'it' ELSE lang END"))
    whole = mix(docs, n_words(), text_margins(topics=2), TARGETS).select("row.lang", "tokens", "probability", "kept", F.col("lang").alias("cell")).toPandas()
    for odd in (whole[whole["lang"].isna()], whole[whole["lang"] == "it"]):
        assert len(odd) == 300 and odd["probability"].min() > 0 and odd["kept"].any()
    weight = whole["tokens"] * whole["probability"]
    share = weight.groupby(whole["cell"]).sum() / weight.sum()
    counted = whole["tokens"][whole["cell"] == "other"].sum() / whole["tokens"].sum()
    assert abs(share["other"] - counted) < 1e-6
    assert abs(share["en"] / share["de"] - 0.6 / 0.4) < 1e-6
    left_out = mix(docs, n_words(), text_margins(topics=2), TARGETS | {"lang": {"en": 0.6, "de": 0.4, "other": 0.0}})
    assert left_out.where("kept and lang = 'other'").count() == 0


def test_registered_targets_keep_unlabelled_documents(spark):
    docs = docs_of(spark).withColumn("lang", F.expr("CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'it' ELSE 'en' END"))
    kept = mix(docs, n_words(), text_margins(), REGISTERED).where("kept").select("row.lang").distinct().collect()
    assert {r.lang for r in kept} == {None, "it", "en"}


def test_margins_that_cannot_be_met_drop_no_cell():
    totals = np.array([[0.0, 5.0], [90.0, 5.0]])  # the first source has the second language only
    found = meet(totals, [np.array([0.25, 0.75]), np.array([0.9, 0.1])])
    assert (found[totals > 0] > 1e-3).all()
    assert (meet(totals, [np.array([0.5, 0.5]), np.array([1.0, 0.0])])[:, 1] == 0).all()


def test_sources_follow_from_their_shares(spark):
    """One source with a hundredth of the rows does not make the sample small."""
    docs = docs_of(spark).withColumn("source", F.expr("CASE WHEN doc_id % 100 = 0 THEN 'src0' ELSE source END"))
    targets = TARGETS | {"source": REGISTERED["source"]}
    whole = mix(docs, n_words(), text_margins(topics=2), targets).toPandas()
    assert set(whole["source"]) == {"a", "b", "c", "d", "src0"} and len(whole) == 3000
    assert (whole["tokens"] * whole["probability"]).sum() / whole["tokens"].sum() > 0.3
    few = mix(docs, n_words(), text_margins(topics=2), TARGETS | {"source": Tempered(values=2)})
    assert few.select("source").distinct().count() == 3


def test_budget(spark):
    docs = docs_of(spark)
    have = docs.select(F.sum(n_words())).first()[0]
    for size in (0.1, 1.0, 2.5):
        mixed = mix(docs, n_words(), text_margins(topics=2), TARGETS, budget=int(size * have))
        whole = mixed.toPandas()
        assert abs((whole["tokens"] * whole["probability"]).sum() - size * have) < 2
        assert ((whole["copies"] - whole["probability"]).abs() < 1).all()
        assert abs((whole["tokens"] * whole["copies"]).sum() / (size * have) - 1) < 0.15
        assert drawn(mixed).count() == whole["copies"].sum() and drawn(mixed).columns == docs.columns


def test_rake_and_draw_against_brute_force(spark):
    """A null and a fifth language, a rare source and a null one among the rows."""
    docs = docs_of(spark, 1200).withColumns(
        {
            "lang": F.expr("CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'it' ELSE lang END"),
            "source": F.expr("CASE WHEN doc_id % 50 = 0 THEN 'src0' WHEN doc_id % 50 = 1 THEN NULL ELSE source END"),
        }
    )
    kept = check_against_brute(docs, REGISTERED)
    assert {r.lang for r in docs.collect() if r.doc_id in kept} == {None, "it", "en", "de"}
