"""Inner equi-join of a large fact side with a measured, usually small, other side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainlane.staging import stage

ROWS_PER_TASK = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20

_ROW_OVERHEAD_BYTES = 32


def measured_bytes(df: DataFrame) -> int | None:
    """Upper estimate of the in-memory size of ``df``, from its row count and the
    lengths of its texts; None where a column type has no such estimate."""
    texts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            texts.append(f.name)
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return None
    length = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    rows, *text_bytes = df.agg(F.count(F.lit(1)), *length).first()
    return rows * (_ROW_OVERHEAD_BYTES + 16 * len(df.columns)) + sum(text_bytes)


def join_measured(
    facts: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    broadcast_max_bytes: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``facts`` joined with ``other`` on ``keys``; each key column appears once.

    ``other`` is written to the shared folder once and measured there. Up to
    ``broadcast_max_bytes`` it is broadcast and the facts are not shuffled;
    beyond that both sides are shuffled with hot keys sliced.
    """
    written = stage(other, "join-side")
    size = measured_bytes(written)
    if size is not None and size <= broadcast_max_bytes:
        return facts.join(F.broadcast(written), list(keys), "inner")
    return sliced_join(facts, written, keys, rows_per_task)


def sliced_join(
    facts: DataFrame, other: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Shuffled inner join that cuts a key into slices where either side has more than
    ``rows_per_task`` rows of it.

    Rows of a key are counted on both sides. A side with n rows of a key gets
    ceil(n / rows_per_task) slices, and each of its rows goes to one slice of its own side
    and to all slices of the other, so every pair meets once and the result is that of the
    plain join.

    The slice of a row follows from its content and its input partition: the
    same when a lost task is run again, and different for copies of one row
    that lie in different partitions.
    """
    keys = list(keys)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    counts = (
        facts.select(*keys, one.alias("_facts"), none.alias("_other"))
        .unionByName(other.select(*keys, none.alias("_facts"), one.alias("_other")))
        .where(_all_present(keys))
        .groupBy(*keys)
        .agg(F.sum("_facts").alias("_facts"), F.sum("_other").alias("_other"))
    )

    def slices(side: str) -> Column:
        return F.ceil(F.col(side) / F.lit(rows_per_task)).cast("bigint").alias(f"{side}_slices")

    # A key that one side lacks joins with nothing and needs no slices.
    hot = stage(
        counts.where((F.greatest("_facts", "_other") > rows_per_task) & (F.least("_facts", "_other") > 0))
        .select(*keys, slices("_facts"), slices("_other")),
        "hot-keys",
    )
    size = measured_bytes(hot)
    if hot.isEmpty():
        return facts.join(other.hint("merge"), keys, "inner")
    if size is not None and size <= BROADCAST_MAX_BYTES:
        hot = F.broadcast(hot)
    left = _in_slices(facts, hot, keys, own="_facts", across="_other")
    right = _in_slices(other, hot, keys, own="_other", across="_facts")
    on = [*keys, "_facts_slice", "_other_slice"]
    return left.join(right.hint("merge"), on, "inner").drop("_facts_slice", "_other_slice")


def _in_slices(rows: DataFrame, hot: DataFrame, keys: list[str], own: str, across: str) -> DataFrame:
    """Each row in a slice of its own side, repeated for each slice of the other side."""
    content = [c for c in rows.columns if c not in keys] or keys
    first = F.lit(0).cast("bigint")
    place = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.col(f"{own}_slices"))
    last = F.coalesce(F.col(f"{across}_slices") - 1, first)
    return (
        rows.where(_all_present(keys))
        .join(hot, keys, "left")
        .withColumn(f"{own}_slice", F.coalesce(place, first))
        .withColumn(f"{across}_slice", F.explode(F.sequence(first, last)))
        .drop("_facts_slices", "_other_slices")
    )


def _all_present(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
