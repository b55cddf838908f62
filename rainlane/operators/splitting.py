"""Training and holdout parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def random_parts(df: DataFrame, train_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Seeded random split. It depends on the partitioning, so give it a table that
    is read from files."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def in_training(key: Column, tenths: int = 7) -> Column:
    """Split by a whole-number key, independent of the partitioning."""
    return F.pmod(key.cast("bigint"), F.lit(10)) < tenths


def hashed_in_training(key: Column, train_share: float, seed: int) -> Column:
    """The same for keys of any type: a share of the hash range."""
    slot = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000))
    return slot < F.lit(int(round(train_share * 1_000_000)))


def stable_parts(df: DataFrame, key: str, train_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    chosen = hashed_in_training(F.col(key), train_share, seed)
    return df.where(chosen), df.where(~F.coalesce(chosen, F.lit(False)))
