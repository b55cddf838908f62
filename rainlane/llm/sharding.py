"""Histogram sort into shards of equal bytes.

Rows are ordered by a key (a hash of the text, so that equal texts are neighbours) and
then by identifier. Splitters are found by counting: each round counts the exact bytes
below a set of candidate boundaries over all partitions, and narrows the interval of each
splitter that is not within its tolerance yet. When all are, rows are exchanged once, by
range, and numbered within their range; the counts of the last round turn these numbers
into gapless slots.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rainlane.llm.common import text_or_empty
from rainlane.staging import stage

LOW = -(2**63)
#: Candidate boundaries of a round, shared by the splitters still open: 1 to 127 for each.
MOST_PROBES, ROUND_PROBES = 127, 16_384
#: At most so many ranges, so that their boundaries (16 bytes each) stay small in each task.
MOST_RANGES = 1_000_000


def below(keys: np.ndarray, ties: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """How many of the sorted ``bounds`` each (key, tie) is at or above."""
    first = np.array([b[0] for b in bounds], np.int64)
    second = np.array([b[1] for b in bounds], np.int64)
    left = np.searchsorted(first, keys, "left")
    right = np.searchsorted(first, keys, "right")
    found = left.copy()
    mixed = np.flatnonzero(left != right)
    for lo in np.unique(left[mixed]):
        rows = mixed[left[mixed] == lo]
        hi = right[rows[0]]
        found[rows] = lo + np.searchsorted(second[lo:hi], ties[rows], "right")
    return found


def count_below(rows: DataFrame, bounds: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each of the sorted ``bounds``, and of all rows at last.

    Each task sends a row for each interval that it has rows in.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, counts = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for frame in frames:
            at = below(frame["key"].to_numpy(), frame["tie"].to_numpy(), bounds)
            counts += np.bincount(at, minlength=len(counts))
            own = np.bincount(at, weights=frame["size"].to_numpy(), minlength=len(counts))
            sizes += own.astype(np.int64)
        have = np.flatnonzero(counts)
        yield pd.DataFrame({"interval": have, "bytes": sizes[have], "n": counts[have]})

    parts = rows.mapInPandas(counted, "interval long, bytes long, n long")
    totals = parts.groupBy("interval").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    sizes, counts = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for r in totals.collect():
        sizes[r.interval], counts[r.interval] = r.bytes, r.n
    return np.cumsum(sizes).tolist(), np.cumsum(counts).tolist()


@dataclass
class Splitter:
    """One boundary that is looked for: ``target`` bytes below it, give or take ``tolerance``.

    Boundaries are numbers that stand for (key, tie). The one looked for is above ``low``
    and not above ``high``; ``best`` is the nearest so far.
    """

    target: float
    tolerance: float
    low: int
    high: int
    best: int
    off: float

    def open(self) -> bool:
        return self.off > self.tolerance and self.high - self.low > 1

    def probes(self, ties: int, count: int) -> list[int]:
        """Boundaries to count at; between texts while the interval spans several of them."""
        step = (self.high - self.low) / (count + 1)
        found = {self.low + round(step * k) for k in range(1, count + 1)} - {self.low, self.high}
        if self.high // ties > self.low // ties + 1:
            found = {p // ties * ties for p in found}
        return [p for p in found if self.low < p < self.high]

    def take(self, boundary: int, bytes_below: int) -> None:
        off = abs(bytes_below - self.target)
        if off < self.off:
            self.best, self.off = boundary, off
        if bytes_below <= self.target:
            self.low = max(self.low, boundary)
        else:
            self.high = min(self.high, boundary)


def find_splitters(
    rows: DataFrame, shards: int, ranges_per_shard: int, tolerance: float
) -> list[tuple[int, int]]:
    """Boundaries of shards x ranges_per_shard ranges of ``rows`` (key, tie, size).

    Those between shards are within ``tolerance`` of a shard's bytes, or at the nearest
    row; those within a shard are looser.
    """
    ends = rows.agg(
        F.min("tie").alias("low"), F.max("tie").alias("high"), F.sum("size").alias("bytes")
    ).first()
    if ends.low is None:
        return []
    base, ties = ends.low, ends.high - ends.low + 1
    lowest, highest = 0, 2**64 * ties
    pieces = shards * ranges_per_shard
    share = ends.bytes / pieces
    found = []
    for k in range(1, pieces):
        outer = k % ranges_per_shard == 0
        slack = tolerance * ends.bytes / shards if outer else share / 4
        found.append(Splitter(share * k, slack, lowest, highest, lowest, share * k))

    def bound(number: int) -> tuple[int, int]:
        return number // ties + LOW, number % ties + base

    while pending := [s for s in found if s.open()]:
        count = max(1, min(MOST_PROBES, ROUND_PROBES // len(pending)))
        probes = sorted({p for s in pending for p in s.probes(ties, count)})
        if not probes:
            break
        sizes, _ = count_below(rows, [bound(p) for p in probes])
        for s in pending:
            # The nearest probes on both sides say all that this round can tell.
            at = bisect_right(sizes, s.target, hi=len(probes))
            for i in {max(at - 1, 0), min(at, len(probes) - 1)}:
                if s.low < probes[i] < s.high:
                    s.take(probes[i], sizes[i])
    return [bound(number) for number in sorted({s.best for s in found} - {lowest})]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    tolerance: float = 0.001,
    range_bytes: int = 64 << 20,
) -> DataFrame:
    """Columns row (all columns of ``docs``), size, shard and slot.

    size is the UTF-8 bytes of the text (null: none) plus 1. The bytes of shards differ
    from an equal share by ``tolerance`` at either end, or by a row where a single row is
    larger. Equal texts stay together unless that would take a boundary beyond the
    tolerance; then they are cut by identifier (null: last). Rows equal in text and
    identifier are never cut. slot numbers the rows of a shard from 0 in order. Beyond
    ``MOST_RANGES`` ranges the ranges get larger. An empty table gives no rows.
    """
    key = F.xxhash64(text_or_empty(text_column))
    tie = F.coalesce(F.col(id_column).cast("long"), F.lit(2**63 - 1))
    size = (F.coalesce(F.octet_length(text_column), F.lit(0)) + 1).cast("long")
    rows = stage(docs.select(key.alias("key"), tie.alias("tie"), size.alias("size")), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (shards * range_bytes)))
    per_shard = min(per_shard, max(1, MOST_RANGES // shards))
    splitters = find_splitters(rows, shards, per_shard, tolerance)
    sizes, counts = count_below(rows, splitters)
    shard_of, slots = _places(sizes, counts, shards, total)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(below(keys.to_numpy(), ties.to_numpy(), splitters), dtype="int32")

    @F.pandas_udf("struct<shard: int, first: long>")
    def place_of(ranges: pd.Series) -> pd.DataFrame:
        at = ranges.to_numpy()
        return pd.DataFrame({"shard": shard_of[at], "first": slots[at]})

    placed = (
        docs.select(F.struct("*").alias("row"), key.alias("key"), tie.alias("tie"), size.alias("size"))
        .withColumn("range", range_of("key", "tie"))
        .withColumn("place", place_of("range"))
        # The number of a range is its partition, so no two ranges fall into one task.
        .repartitionById(len(splitters) + 1, "range")
    )
    order = Window.partitionBy("range").orderBy("key", "tie")
    slot: Column = F.col("place.first") + F.row_number().over(order) - 1
    return placed.select("row", "size", F.col("place.shard").alias("shard"), slot.alias("slot"))


def _places(
    sizes: list[int], counts: list[int], shards: int, total: int
) -> tuple[np.ndarray, np.ndarray]:
    """Shard and first slot of each range: a range is in the shard that its middle byte is in."""
    starts, first = [0, *sizes[:-1]], [0, *counts[:-1]]
    shard = [
        min(shards - 1, int((lo + hi) / 2 * shards / total)) if total else 0
        for lo, hi in zip(starts, sizes)
    ]
    opening: dict[int, int] = {}
    for s, at in zip(shard, first):
        opening.setdefault(s, at)
    slots = [at - opening[s] for s, at in zip(shard, first)]
    return np.array(shard, np.int64), np.array(slots, np.int64)
