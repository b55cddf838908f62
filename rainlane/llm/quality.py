"""Quality scores by positive-unlabelled learning.

A linear model over fixed random cosine features is fitted by the non-negative unbiased
risk of trusted positives and unlabelled text, with the squared loss. For that loss the
risk of any weights follows from means and second moments of the features, so one pass
over all documents gathers all that the fit needs, in matrices of a fixed size. The class
prior is the least ratio, over score thresholds, of the share of unlabelled documents above
to the share of trusted positives above: negatives are rare where the score is highest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainlane.llm.common import freeing, with_row

COSINES = 256
REDUCERS, FAN_IN = 8, 64
BINS = 200
CHUNK = 1 << 20


def _byte_class() -> np.ndarray:
    """Class of each byte: marks one by one, then digits, capitals, small letters, blanks,
    other controls, continuation bytes, and first bytes of longer characters."""
    classes, marks = np.zeros(256, np.int64), 0
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            classes[b] = 6
        elif b >= 0x80:
            classes[b] = 5
        elif c.isdigit():
            classes[b] = 0
        elif c.isupper():
            classes[b] = 1
        elif c.islower():
            classes[b] = 2
        elif c in " \t\n\v\f\r":
            classes[b] = 3
        elif b < 0x20 or b == 0x7F:
            classes[b] = 4
        else:
            classes[b] = 7 + marks
            marks += 1
    return classes


CLASSES = _byte_class()
N_CLASSES = int(CLASSES.max()) + 1


def text_features(text: str | None) -> np.ndarray:
    """Numbers that describe the whole text; null counts as empty.

    Shares of kinds of characters, length, words and their variety, repetition, lines.
    """
    content = (text or "").encode("utf-8", "surrogatepass")
    counts = np.zeros(256, np.int64)
    for at in range(0, len(content), CHUNK):
        counts += np.bincount(np.frombuffer(content[at : at + CHUNK], np.uint8), minlength=256)
    kinds = np.bincount(CLASSES, weights=counts, minlength=N_CLASSES)
    words = (text or "").split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    first = [word[0] for word in words]
    capital = sum(c.isupper() for c in first)
    upper = sum(map(str.isupper, words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(word[-1] in ".!?" for word in words)
    marked = sum(not word[-1].isalnum() for word in words)
    lines = (text or "").split("\n")
    some = max(n, 1)
    return np.array(
        [
            *np.sqrt(kinds / max(len(content), 1)),
            np.log1p(len(content)),
            np.log1p(n),
            lengths.mean() if n else 0,
            lengths.std() if n else 0,
            np.sqrt(lengths.max() if n else 0),
            len(set(words)) / some,
            len(set(words)) / np.sqrt(some),
            len(set(zip(words, words[1:]))) / max(n - 1, 1),
            np.sqrt(repeats / some),
            capital / some,
            np.sqrt(upper / some),
            np.sqrt(ends / some),
            np.sqrt(marked / some),
            np.log1p(n / max(ends, 1)),
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
            np.log1p(n / len(lines)),
        ],
        np.float32,
    )


N_NUMBERS = N_CLASSES + 17


def featurise(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Columns row (all columns of ``docs`` but the text) and numbers (float32 of the text).

    Null and empty texts have numbers too; repeated rows and an empty table are fine.
    """

    @freeing
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["row", "numbers"]
            )

    rest = [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns if name != text_column]
    given = docs.select(F.struct(*rest).alias("row"), F.col(text_column).alias("text"))
    return given.mapInArrow(numbered, with_row(given, "numbers binary"))


def _matrix(numbers: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(numbers), np.float32).reshape(-1, N_NUMBERS).astype(np.float64)


def add_up(features: DataFrame, values_of, size: int) -> np.ndarray:
    """Sum over all rows of a vector of ``size`` numbers that ``values_of`` gives per frame.

    Tasks add up their own rows, and reducers the sums of ``FAN_IN`` tasks one after another,
    in as many levels as it takes until ``REDUCERS`` are left, which the driver adds up.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for frame in frames:
            for at in range(0, len(frame), 2000):
                total += values_of(frame.iloc[at : at + 2000])
        yield pd.DataFrame({"slot": [TaskContext.get().partitionId()], "total": [total.tobytes()]})

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for own in frame["total"]:
                total = np.frombuffer(own) + (0 if total is None else total)
        if total is not None:  # a reducer that got nothing sends nothing
            yield pd.DataFrame({"slot": [TaskContext.get().partitionId()], "total": [total.tobytes()]})

    schema = "slot int, total binary"
    parts, width = features.mapInPandas(partial, schema), features.rdd.getNumPartitions()
    while True:
        width = max(REDUCERS, -(-width // FAN_IN))
        place = F.pmod("slot", F.lit(width))
        parts = parts.repartition(width, place).mapInPandas(joined, schema)
        if width == REDUCERS:
            break
    rows = parts.collect()
    return sum((np.frombuffer(r.total) for r in rows), np.zeros(size))


@dataclass(frozen=True)
class Basis:
    """Standardised numbers, a constant, and cosines of fixed random directions of them."""

    mean: np.ndarray
    scale: np.ndarray
    seed: int = 17

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        width = N_NUMBERS
        directions = rng.normal(size=(width, COSINES)) / np.sqrt(width)
        phases = rng.uniform(0, 2 * np.pi, COSINES)
        z = np.clip((numbers - self.mean) / self.scale, -5, 5)
        one = np.ones((len(z), 1))
        return np.hstack([one, z, np.cos(z @ directions + phases)])

    @property
    def size(self) -> int:
        return 1 + N_NUMBERS + COSINES


@dataclass(frozen=True)
class Moments:
    """Number of rows, mean and second moment of the features of one set of rows."""

    n: float
    mean: np.ndarray
    second: np.ndarray

    def loss(self, weights: np.ndarray, label: int) -> float:
        """Mean of (1 - label * f)² / 4."""
        inner = 1 - 2 * label * weights @ self.mean + weights @ self.second @ weights
        return float(inner) / 4

    def slope(self, weights: np.ndarray, label: int) -> np.ndarray:
        return (self.second @ weights - label * self.mean) / 2


def fit(positive: Moments, unlabelled: Moments, prior: float, ridge: float = 1e-3) -> np.ndarray:
    """Weights of least non-negative risk.

    The unbiased risk has its least value in closed form. Where the part that stands for
    the negatives, R_u(-1) - prior * R_p(-1), comes out below zero there, the weights move
    on: up that part while it is negative, else down the whole risk, and the best seen
    under max(0, ·) are kept.
    """
    size = len(positive.mean)
    penalty = ridge * np.eye(size)
    penalty[0, 0] = 1e-9
    weights = np.linalg.solve(
        unlabelled.second / 2 + penalty, prior * positive.mean - unlabelled.mean / 2
    )

    def negative_part(w: np.ndarray) -> float:
        return unlabelled.loss(w, -1) - prior * positive.loss(w, -1)

    def risk(w: np.ndarray) -> float:
        return prior * positive.loss(w, 1) + max(0.0, negative_part(w)) + w @ penalty @ w / 2

    best, least = weights, risk(weights)
    if negative_part(weights) >= 0:
        return best
    step = 1 / (np.linalg.eigvalsh(unlabelled.second + positive.second)[-1] + ridge)
    w = weights.copy()
    for _ in range(2000):
        down = unlabelled.slope(w, -1) - prior * positive.slope(w, -1)
        if negative_part(w) < 0:
            w = w + step * down
        else:
            w = w - step * (prior * positive.slope(w, 1) + down + penalty @ w)
        if (now := risk(w)) < least:
            best, least = w.copy(), now
    return best


@dataclass(frozen=True)
class Model:
    basis: Basis
    weights: np.ndarray
    prior: float

    def margins(self, numbers: np.ndarray) -> np.ndarray:
        return self.basis(numbers) @ self.weights


def learn(features: DataFrame, first_prior: float = 0.5) -> Model | None:
    """Fit on all rows of ``features`` (role, numbers) with a role: 1 a trusted positive,
    0 unlabelled, null neither. None where positives or unlabelled rows are lacking."""
    half = F.pmod(F.xxhash64("numbers"), F.lit(2)).cast("int").alias("half")
    rows = features.where("role is not null").select("role", "numbers", half)

    def spread(frame: pd.DataFrame) -> np.ndarray:
        x = _matrix(frame["numbers"])
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    sums = add_up(rows, spread, 1 + 2 * N_NUMBERS)
    if not sums[0]:
        return None
    mean = sums[1 : 1 + N_NUMBERS] / sums[0]
    scale = np.sqrt(np.maximum(sums[1 + N_NUMBERS :] / sums[0] - mean**2, 1e-8))
    basis = Basis(mean, scale)
    size = basis.size

    def moments(frame: pd.DataFrame) -> np.ndarray:
        x, role, half = basis(_matrix(frame["numbers"])), frame["role"].to_numpy(), frame["half"].to_numpy()
        parts = []
        for chosen in (half == 0, half == 1):
            for own in (x[chosen & (role == 1)], x[chosen]):
                parts += [[len(own)], own.sum(axis=0), (own.T @ own).ravel()]
        return np.concatenate(parts)

    halves = add_up(rows, moments, 4 * (1 + size + size * size)).reshape(2, 2, -1)
    both = halves.sum(axis=0)
    if not both[0, 0] or both[0, 0] == both[1, 0]:
        return None

    def fitted(sums: np.ndarray, prior: float) -> np.ndarray:
        n = np.maximum(sums[:, :1], 1)
        means = sums / n
        positive, unlabelled = (
            Moments(float(c[0]), m[1 : 1 + size], m[1 + size :].reshape(size, size)) for c, m in zip(n, means)
        )
        # Few positives say less than many, and are followed less closely.
        return fit(positive, unlabelled, prior, ridge=1e-3 + 2 / positive.n)

    crossed = [Model(basis, fitted(halves[1 - h], first_prior), first_prior) for h in (0, 1)]
    prior = estimate_prior(rows, crossed)
    return Model(basis, fitted(both, prior), prior)


def estimate_prior(rows: DataFrame, models: list[Model]) -> float:
    """Share of positives among the unlabelled, from the shares of both above thresholds.

    Each half of the rows is scored by the model of the other half, so that no row counts
    as a positive because the model has seen that it is one. Each share is taken a standard
    error to the side that makes the ratio larger, so thresholds with few rows above say
    little.
    """

    def histograms(frame: pd.DataFrame) -> np.ndarray:
        numbers, half = _matrix(frame["numbers"]), frame["half"].to_numpy()
        margins = np.where(half == 0, models[0].margins(numbers), models[1].margins(numbers))
        at = (np.clip((margins + 2) / 4, 0, 1 - 1e-9) * BINS).astype(np.int64)
        role = frame["role"].to_numpy()
        return np.concatenate(
            [np.bincount(at[role == 1], minlength=BINS), np.bincount(at, minlength=BINS)]
        )

    positive, unlabelled = (
        np.cumsum(own[::-1]) for own in add_up(rows, histograms, 2 * BINS).reshape(2, BINS)
    )

    def share_and_error(above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = above / above[-1]
        return share, np.sqrt(share * (1 - share) / above[-1])

    (p, p_error), (u, u_error) = share_and_error(positive), share_and_error(unlabelled)
    sure = p > 2 * p_error
    ratio = (u + u_error)[sure] / (p - p_error)[sure]
    return float(np.clip(ratio.min(), 0.05, 0.95))


def score(features: DataFrame, model: Model | None) -> DataFrame:
    """Columns row and score, 0 to 1: the higher, the likelier a positive.

    Empty texts are scored like others. Without a model each score is 0.5.
    """

    def scored(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if model is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = model.margins(_matrix(batch.column(1).to_pylist()))
                found = 1 / (1 + np.exp(-2 * np.clip(found, -15, 15)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["row", "score"])

    return features.select("row", "numbers").mapInArrow(scored, with_row(features, "score double"))
