import numpy as np
import pytest

from rainlane.llm import embedding_dedup as own

SCHEMA = "vec_id long, embedding array<float>, row string, dim string, label int"


def brute(rows, threshold):
    usable = {}
    for i, (_, v, *_) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            v = np.array(v, np.float32).astype(float)
            usable[i] = v / np.linalg.norm(v)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in usable:
        for j in usable:
            if j < i and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    least = {}
    for i, (key, *_) in enumerate(rows):
        least.setdefault(find(i), []).append(float("inf") if key is None else key)
    found = []
    for i, (key, *_) in enumerate(rows):
        least_id = min(least[find(i)])
        least_id = None if least_id == float("inf") else least_id
        found.append((key, links[i], least_id, key == least_id))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=32).astype(np.float32).tolist(), "r", None, 1) for i in range(150)]
    key = 150
    for size, noise in ((80, 0.01), (12, 0.03), (6, 0.05)):
        base = rng.normal(size=32)
        for _ in range(size):
            v = (base + noise * rng.normal(size=32) * np.linalg.norm(base) / 5) * rng.uniform(0.1, 9)
            rows.append((key, v.astype(np.float32).tolist(), None, "d", None))
            key += 1
    odd = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [1.0, 0.0, 0.0], [2.0, 0.0, 0.0]]
    rows += [(key + i, v, "r", "d", 0) for i, v in enumerate(odd)]
    return rows + [(3, rows[3][1], "r", "d", 0), (None, rows[3][1], None, None, None), (None, [1.0] + [0.0] * 31, "r", "d", 1)]


@pytest.mark.parametrize("tile", [512, 16])
def test_against_brute_force(spark, rows, monkeypatch, tile):
    monkeypatch.setattr(own, "TILE", tile)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = own.near_duplicates(vectors).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 0.9)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    a = rng.normal(size=64)
    b = a + rng.normal(size=64) * 0.5
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    found, inside = [], 0
    for seed in range(2000):
        turned = np.stack([a, b]) @ np.linalg.qr(np.random.default_rng(seed).normal(size=(64, 64)))[0]
        factor = np.abs(turned[0]).sum() / 8
        found.append(np.sign(turned[0]) @ turned[1] / 8 / factor)
        off = own.SIGMAS * np.sqrt(1 - factor**2) / (factor * np.sqrt(63))
        inside += abs(found[-1] - a @ b) <= off
    assert abs(np.mean(found) - a @ b) < 0.005
    assert inside / len(found) > 0.99


def test_chance_to_meet_grows_with_tables():
    bits, tables = own.tables_for(50_000, 0.9, 0.999)
    meet = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 1 - (1 - meet) ** tables >= 0.999 > 1 - (1 - meet) ** (tables - 1)


def test_empty_table(spark):
    assert own.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("dim", [16, 64])
@pytest.mark.parametrize("rows", [51_282, 15_000_000])
def test_recall_of_planted_pairs(dim, rows):
    """Pairs at a cosine of 0.90 to 0.92 share a bucket as surely as is said."""
    bits, tables = own.tables_for(rows, 0.9, 0.999)
    rng = np.random.default_rng(dim)
    a, b = rng.normal(size=(2, 6000, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    for cosine, least in ((0.9, 0.9975), (0.92, 0.9995)):
        met = 0
        for seed in range(4):
            coder = own.Coder(dim, bits, tables, seed)
            part = slice(1500 * seed, 1500 * (seed + 1))
            close = cosine * a[part] + np.sqrt(1 - cosine**2) * b[part]
            met += (coder.code(a[part])[2] == coder.code(close)[2]).any(axis=1).sum()
        assert met / 6000 >= least


def test_equal_vectors_are_one(spark, rows):
    """Thousands of copies, whose pairs are never enumerated."""
    far = rows[0][1]
    near = [x + 0.01 for x in far]
    many = [(10_000 + i, far, "r", None, 1) for i in range(3000)] + [(20_000 + i, near, "r", None, 1) for i in range(5)]
    vectors = spark.createDataFrame([*many, *rows[:20]], SCHEMA)
    found = {r.id: r for r in own.near_duplicates(vectors).collect()}
    assert found[10_000].n_links == 3000 + 5 and found[20_004].n_links == 4 + 3001 and found[0].n_links == 3005
    assert {found[i].component_id for i in (0, 10_000, 12_999, 20_000)} == {0} and found[0].kept and not found[10_001].kept
