"""Equal-width, right-closed bins between a lowest and a highest value."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_edges(lo: float, hi: float, bins: int) -> list[float]:
    """The ``bins + 1`` edges.

    The first edge is lowered by 0.1 % of the range, so that the lowest value
    falls inside a right-closed bin. A range of one single value is first
    widened by 0.1 % (0.001 around zero) to each side.
    """
    if math.isinf(lo) or math.isinf(hi):
        raise ValueError("an infinite value has no equal-width bin")
    start, end = lo, hi
    if lo == hi:
        start -= 0.001 * abs(lo) if lo != 0 else 0.001
        end += 0.001 * abs(hi) if hi != 0 else 0.001
    width = (end - start) / bins
    first = start if lo == hi else start - (end - start) * 0.001
    return [first, *(i * width + start for i in range(1, bins)), end]


def equal_width_bin(value: Column, edges: list[float]) -> Column:
    """Bin number of ``value``: how many inner edges lie below it; NULL stays NULL.

    Comparing with the edges gives the right bin also for values on an edge,
    which dividing by the bin width does not. The comparisons form a balanced
    tree over constants, which stays short in generated code.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(value > edges[middle], search(middle, high)).otherwise(
            search(low, middle - 1)
        )

    return F.when(value.isNotNull(), search(0, len(edges) - 2)).cast("int")
