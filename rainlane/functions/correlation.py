"""Pearson correlation that is NULL, not an error, where a variance is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(a: Column, b: Column) -> Column:
    """One-pass aggregate over the rows where both values are present."""
    a_paired = F.when(b.isNotNull(), a)
    b_paired = F.when(a.isNotNull(), b)
    return F.try_divide(
        F.covar_pop(a, b), F.stddev_pop(a_paired) * F.stddev_pop(b_paired)
    )


def clipped(r: Column) -> Column:
    """Rounding can push a perfect correlation past 1; NULL stays NULL."""
    return F.when(r.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r)))
