import numpy as np
import pytest
from pyspark.sql import functions as F

from rainlane.llm import quality
from rainlane.llm.quality import N_NUMBERS, Moments, featurise, fit, learn, score, text_features

SCHEMA = "doc_id long, text string, role string, numbers string"


def test_features_of_odd_texts():
    for text in (None, "", "   ", "a", "\n\n", "🙂" * 3, "word " * 200_000, "x" * 2_000_000):
        found = text_features(text)
        assert found.shape == (N_NUMBERS,) and np.isfinite(found).all()


def moments(x):
    return Moments(len(x), x.mean(axis=0), x.T @ x / len(x))


def test_fit_finds_the_least_non_negative_risk():
    rng = np.random.default_rng(3)
    made = [np.hstack([np.ones((400, 1)), rng.normal(m, 1, (400, 2))]) for m in (1.0, -1.0)]
    positive, unlabelled = moments(made[0]), moments(np.vstack(made))
    weights = fit(positive, unlabelled, 0.5, ridge=1e-6)

    def risk(w):
        p = lambda y: np.mean((1 - y * made[0] @ w) ** 2) / 4
        u = np.mean((1 + np.vstack(made) @ w) ** 2) / 4
        return 0.5 * p(1) + max(0.0, u - 0.5 * p(-1))

    nearby = [risk(weights + rng.normal(0, s, 3)) for s in (0.01, 0.1, 0.5) for _ in range(50)]
    assert risk(weights) <= min(nearby) + 1e-6
    # With too high a prior the part of the negatives would fall below zero.
    bounded = fit(positive, unlabelled, 0.9, ridge=1e-6)
    assert np.isfinite(bounded).all()


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "rho", "sigma"]

    def good():
        return " ".join(rng.choice(words, rng.integers(20, 60))).capitalize() + "."

    def bad():
        return f"{rng.choice(words)} !! ".upper() * int(rng.integers(5, 30))

    rows = [(i, good() if i % 4 else bad(), "r", None) for i in range(400)] + [(400, None, None, None), (401, "", "r", "n")]
    return spark.createDataFrame(rows, SCHEMA)


def test_learns_from_positives_and_unlabelled(texts):
    features = featurise(texts)
    role = F.when(F.col("row.doc_id") % 5 == 0, None).when(
        (F.col("row.doc_id") % 4 != 0) & (F.col("row.doc_id") % 3 == 0), 1
    ).otherwise(0)
    features = features.withColumn("role", role)
    model = learn(features)
    assert 0.55 < model.prior <= 0.95
    rows = score(features, model).collect()
    held = [(r.score, r.row.doc_id % 4 != 0) for r in rows if r.row.doc_id % 5 == 0 and r.row.doc_id < 400]
    better = [a > b for a, good in held if good for b, other in held if not other]
    assert len(held) > 70 and np.mean(better) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 402


def test_without_roles_and_without_rows(texts):
    features = featurise(texts).withColumn("role", F.lit(None).cast("int"))
    assert learn(features) is None
    assert {r.score for r in score(features, None).collect()} == {0.5}
    empty = featurise(texts.where("doc_id < 0")).withColumn("role", F.lit(0))
    assert learn(empty) is None and score(empty, None).collect() == []


def test_sums_in_levels(spark, monkeypatch):
    monkeypatch.setattr(quality, "FAN_IN", 2)
    monkeypatch.setattr(quality, "REDUCERS", 2)
    frame = spark.range(0, 1000, 1, 23).selectExpr("double(id) AS x")
    found = quality.add_up(frame, lambda own: np.array([own["x"].sum(), len(own)]), 2)
    assert found.tolist() == [499_500, 1000]
