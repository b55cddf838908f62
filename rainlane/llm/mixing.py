"""Mixing of sources, languages and topics to target weights.

Token weights per cell (one value of each margin) are raked by iterative proportional
fitting until every margin has its target share. A document is then kept with a chance in
proportion to how much its cell was raised or lowered.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.staging import stage

OTHER = "other"
MOST_ROUNDS, CLOSE, MET = 1000, 1e-9, 1e-6


@dataclass(frozen=True)
class Tempered:
    """Targets of a margin that follow from its data: every value is named, with its counted
    share to the power ``power``, raised against the most common value at most ``most`` times,
    so that a rare value can't make the sample small. Values beyond the ``values`` most
    common, and null, count as one."""

    power: float = 0.7
    most: float = 2.0
    values: int = 1000

    def shares(self, counted: np.ndarray) -> np.ndarray:
        part = counted / max(counted.max(), 1)
        raised = np.power(part, self.power - 1, out=np.ones_like(part), where=part > 0)
        wanted = part * np.minimum(raised, self.most)
        return wanted / max(wanted.sum(), 1e-300)


Targets = Mapping[str, Mapping[str, float] | Tempered]


def n_words(text_column: str = "text") -> Column:
    """Weight of a document: its words, at least 1; null counts as empty."""
    words = F.size(F.split(F.trim(F.coalesce(F.col(text_column), F.lit(""))), r"\s+"))
    return F.greatest(words, F.lit(1)).cast("long")


def keyword_topic(topics: int = 8) -> Callable[[Column], Column]:
    """A text's topic by its keyword, the most frequent word of five characters or more
    (ties: the smallest); texts with the same keyword have the same topic."""

    @F.pandas_udf("string")
    def topic(texts: pd.Series) -> pd.Series:
        found = []
        for text in texts:
            counts = Counter((text or "").lower().split())
            best = max(
                ((n, word) for word, n in counts.items() if len(word) >= 5),
                key=lambda own: (own[0], [-ord(c) for c in own[1]]),
                default=(0, ""),
            )
            digest = hashlib.blake2b(best[1].encode("utf-8", "surrogatepass"), digest_size=8).digest()
            found.append(f"topic{int.from_bytes(digest, 'little') % topics}")
        return pd.Series(found, dtype=object)

    return topic


def text_margins(
    source: str = "source", lang: str = "lang", text: str = "text", topics: int = 8
) -> dict[str, Column]:
    """The margins source, language and topic of a table of documents."""
    return {
        "source": F.col(source),
        "lang": F.col(lang),
        "topic": keyword_topic(topics)(F.col(text)),
    }


def rake(totals: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Weights with the margins ``targets`` (shares) that keep the ratios within ``totals``.

    Targets of values without any tokens are dealt to the others in proportion. Margins that
    can't be met together, as when a cell they need is empty, are left as near as
    ``MOST_ROUNDS`` rounds bring them; the last of ``targets`` is then met and the others
    aren't.
    """
    weights = totals.astype(np.float64)
    if not weights.sum():
        return weights
    axes = range(weights.ndim)
    goals = []
    for axis, target in zip(axes, targets):
        have = weights.sum(axis=tuple(a for a in axes if a != axis)) > 0
        goal = np.where(have, target, 0.0)
        goals.append(goal / goal.sum() if goal.sum() else have / have.sum())
    weights = weights / weights.sum()
    for _ in range(MOST_ROUNDS):
        off = 0.0
        for axis, goal in zip(axes, goals):
            now = weights.sum(axis=tuple(a for a in axes if a != axis))
            off = max(off, float(np.abs(now - goal).max()))
            factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            shape = [-1 if a == axis else 1 for a in axes]
            weights = weights * factor.reshape(shape)
        if off < CLOSE:
            break
    return weights


def wanted_shares(own: Mapping[str, float] | Tempered, names: list[str], counted: np.ndarray) -> np.ndarray:
    """Shares of ``names`` and, last, of all other values: the share that ``own`` gives
    ``OTHER``, or what the named ones leave of 1, or, where they leave nothing, the counted
    one. In that case the named ones share the rest as ``own`` says."""
    if isinstance(own, Tempered):
        return own.shares(counted)
    named = np.array([own[name] for name in names], np.float64)
    rest = own.get(OTHER, 1 - named.sum())
    if OTHER not in own and rest < CLOSE:
        rest = counted[-1] / max(counted.sum(), 1)
        named = named / named.sum() * (1 - rest)
    return np.array([*named, rest])


def meet(totals: np.ndarray, shares: list[np.ndarray]) -> np.ndarray:
    """``rake`` to ``shares``, or, where these can't be met together, to the shares nearest
    to them, in steps of a quarter towards the counted ones, that can. The counted ones
    always can, so no cell is driven to 0 but by a share of 0."""
    axes = range(totals.ndim)

    def margins(weights: np.ndarray) -> list[np.ndarray]:
        return [weights.sum(axis=tuple(a for a in axes if a != axis)) / max(weights.sum(), 1e-300) for axis in axes]

    weights = totals.astype(np.float64)
    for axis, share in zip(axes, shares):
        weights = weights * (share > 0).reshape([-1 if a == axis else 1 for a in axes])
    counted = margins(weights)
    wanted = [np.where(have > 0, share, 0.0) for have, share in zip(counted, shares)]
    for part in (0, 0.25, 0.5, 0.75, 1):
        goals = [(1 - part) * w / max(w.sum(), 1e-300) + part * c for w, c in zip(wanted, counted)]
        found = rake(weights, goals)
        if all(np.abs(now - goal).max() < MET for now, goal in zip(margins(found), goals)):
            break
    return found


def calibrate(
    docs: DataFrame,
    tokens: Column,
    margins: Mapping[str, Column],
    targets: Targets,
    budget: int | None = None,
) -> DataFrame:
    """Columns row (all columns of ``docs``), tokens, probability and one for each margin.

    ``targets`` has the wanted share of tokens for each named value of a margin; what is
    left of 1 goes to all other values together, null among them. Where nothing is left, they
    keep the share they have; only a share of 0 given to ``OTHER`` drops them. With
    ``Tempered`` the values are named by the data. So there are no more cells than the
    targets allow, whatever the data, and only their totals come to the driver.

    All of ``docs`` is written once on the way, so give it without columns that are not needed.

    ``budget`` is the expected number of tokens drawn; a probability above 1 is then the
    expected number of copies. Without it the cell that is raised most is kept whole, others
    in proportion. An empty table gives no rows.
    """
    placed = docs.select(
        F.struct("*").alias("row"),
        tokens.cast("long").alias("tokens"),
        *[margins[name].cast("string").alias(name) for name in targets],
    )
    # Written once: tokens and margins may cost a pass over the texts.
    placed = stage(placed, "mixing-placed")
    values = {name: [*(v for v in own if v != OTHER), OTHER] for name, own in targets.items() if not isinstance(own, Tempered)}

    def narrowed(frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {n: F.when(F.col(n).isin(own[:-1]), F.col(n)).otherwise(F.lit(OTHER)) for n, own in values.items()}
        )

    cells = narrowed(placed).groupBy(*targets).agg(F.sum("tokens").alias("total"))
    tempered = {name: own for name, own in targets.items() if isinstance(own, Tempered)}
    if tempered:
        cells = stage(cells, "mixing-cells")
    for name, own in tempered.items():
        by_value = cells.where(F.col(name) != OTHER).groupBy(name).agg(F.sum("total").alias("total"))
        most = by_value.orderBy(F.desc("total"), name).limit(own.values).collect()
        values[name] = [*sorted(r[name] for r in most), OTHER]
    cells = narrowed(cells).groupBy(*targets).agg(F.sum("total").alias("total")).collect()

    values = {name: values[name] for name in targets}
    at = {name: {v: k for k, v in enumerate(own)} for name, own in values.items()}
    totals = np.zeros([len(own) for own in values.values()])
    for cell in cells:
        totals[tuple(at[name][cell[name]] for name in targets)] = cell.total
    shares = []
    for axis, (name, own) in enumerate(targets.items()):
        counted = totals.sum(axis=tuple(a for a in range(totals.ndim) if a != axis))
        shares.append(wanted_shares(own, values[name][:-1], counted))
    raised = np.divide(meet(totals, shares), totals, out=np.zeros_like(totals), where=totals > 0)
    if budget is not None:
        raised = raised * budget
    elif raised.max() > 0:
        raised = raised / raised.max()
    found = [
        (*(cell[name] for name in targets), float(raised[tuple(at[name][cell[name]] for name in targets)]))
        for cell in cells
    ]
    schema = ", ".join([*(f"`{name}` string" for name in targets), "probability double"])
    table = docs.sparkSession.createDataFrame(found, schema)
    joined = narrowed(placed).join(F.broadcast(table), list(targets))
    return joined.select("row", "tokens", *targets, "probability")


def draw(id_column: Column, seed: int = 0) -> Column:
    """A number from 0 to 1 that the identifier (null or not) and the seed decide."""
    return F.pmod(F.xxhash64(id_column, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    tokens: Column,
    margins: Mapping[str, Column],
    targets: Targets,
    id_column: str = "doc_id",
    seed: int = 0,
    budget: int | None = None,
) -> DataFrame:
    """``calibrate``, copies and kept: how often the document is drawn and whether it is. Rows
    that share an identifier are drawn alike if their cells are."""
    calibrated = calibrate(docs, tokens, margins, targets, budget)
    whole = F.floor("probability")
    again = draw(F.col(f"row.{id_column}"), seed) < F.col("probability") - whole
    copies = (whole + again.cast("long")).cast("long")
    return calibrated.withColumn("copies", copies).withColumn("kept", F.col("copies") > 0)


def drawn(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` as often as they are drawn."""
    kept = mixed.where("kept")
    return kept.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
