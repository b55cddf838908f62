"""Row counts at each stage of the raw -> trusted step."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rainlane.schemas import LONG, TEXT, struct

STAGE_COUNTS = struct(stage=TEXT, n_rows=LONG)


@contextmanager
def counted_stages(spark: SparkSession, path: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Give a function that has the rows of a frame counted as they pass by, and write all
    counts to ``path`` after the block, in which each frame has to be computed."""
    seen: dict[str, tuple[Observation, DataFrame]] = {}

    def count(rows: DataFrame, name: str) -> DataFrame:
        own = Observation(name)
        seen[name] = own, rows
        return rows.observe(own, F.count(F.lit(1)).alias("n"))

    yield count
    # What the engine found needless to compute, as the other side of an empty join, is
    # counted on its own.
    counts = [(name, own.get["n"] if "n" in own.get else rows.count()) for name, (own, rows) in seen.items()]
    spark.createDataFrame(counts, STAGE_COUNTS).write.mode("overwrite").parquet(path)


def stage_counts(docs: DataFrame, days: DataFrame, incidents: DataFrame, key: str) -> DataFrame:
    """Rows of the documents, the unpacked days, the incidents and their join.

    Days and incidents are counted per key first, so each is read once and only
    counts are shuffled; a key with n incidents and m days stands for n x m
    joined rows.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    per_key = (
        days.select(key, one.alias("days"), none.alias("incidents"))
        .unionByName(incidents.select(key, none.alias("days"), one.alias("incidents")))
        .groupBy(key)
        .agg(F.sum("days").alias("days"), F.sum("incidents").alias("incidents"))
    )
    stages = {
        "weather_days": F.col("days"),
        "incident_rows": F.col("incidents"),
        "joined_rows": F.when(F.col(key).isNotNull(), F.col("days") * F.col("incidents")),
    }
    counted = per_key.agg(
        *(F.coalesce(F.sum(n), none).alias(name) for name, n in stages.items())
    ).select(
        F.inline(
            F.array(
                *(F.struct(F.lit(s).alias("stage"), F.col(s).alias("n_rows")) for s in stages)
            )
        )
    )
    documents = docs.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("weather_documents").alias("stage"), "n_rows"
    )
    return documents.unionByName(counted)
