"""Keeps the trusted table up with the raw zone by redoing only the months that changed."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rainlane.plans.trusted import join_typed
from rainlane.schemas import DATE, FILE_VERSION, LONG, TEXT, TRUSTED, struct
from rainlane.settings import Layout, Settings
from rainlane.staging import remove, stage
from rainlane.streaming.arrivals import (
    compact,
    ingest,
    land_unknown,
    landed_rows,
    list_raw,
    month_of,
)
from rainlane.streaming.ledger import SIDES, VERSION, live_files, read_or_empty

MANIFEST = struct(side=TEXT, **{f.name: f.dataType for f in FILE_VERSION.fields}, month=DATE)
STATE = struct(n=LONG, mark=LONG)


Listings = dict[str, DataFrame]


def listings_of(spark: SparkSession, layout: Layout) -> Listings:
    """The raw zone as it is now."""
    return {side: list_raw(spark, layout, side) for side in SIDES}


def refresh_trusted(
    spark: SparkSession, layout: Layout, settings: Settings, listings: Listings | None = None
) -> list[date]:
    """Redo the months whose sources aren't those they were last built from; these months.

    A manifest says what each month was built from, and is written after the month. So a
    rerun of an export, a rewritten or a deleted file, and a late one redo their months, a
    run that failed is made up for by the next one, and a repeated run does nothing. What
    there is to do follows from manifest, ledger and listing; a month is built from all its
    live rows and replaces its old files, and landed rows of other months are not read.
    """
    listings = listings or listings_of(spark, layout)
    files = [live_files(spark, layout, side, listings[side]).withColumn("side", F.lit(side)) for side in SIDES]
    live = stage(reduce(DataFrame.unionByName, files).where("month is not null"), "live-files")
    keys = MANIFEST.fieldNames()
    now, was = live.select(*keys).distinct(), read_or_empty(spark, layout.trusted_sources, MANIFEST)
    both = now.withColumns({"now": F.lit(1), "was": F.lit(0)}).unionByName(was.withColumns({"now": F.lit(0), "was": F.lit(1)}))
    by_file = both.groupBy(*keys).agg(F.max("now").alias("now"), F.max("was").alias("was"))
    by_month = by_file.groupBy("month").agg(F.max(F.col("now") != F.col("was")).alias("changed"), F.max("now").alias("now"))
    found = by_month.where("changed").collect()
    months = sorted(r.month for r in found)
    if not months:
        return months
    in_months = F.col("month").isin(months)
    batches = live.where(in_months).select("side", "batch").distinct().collect()

    def of_months(side: str) -> DataFrame:
        own = live.where(in_months & (F.col("side") == side))
        rows = landed_rows(spark, layout, side, own, [r.batch for r in batches if r.side == side]).where(in_months)
        return rows.drop(*VERSION, "month")

    rows = join_typed(of_months("weather"), of_months("incidents"), settings)
    seen = Observation("months")
    # Rebalancing gathers a month into few files and splits a month that is too large.
    rows = rows.withColumn("month", month_of()).observe(seen, F.collect_set("month").alias("months"))
    _replace_months(rows.hint("rebalance", "month"), layout.trusted_by_month)
    for month in set(months) - set(seen.get.get("months") or []):
        remove(spark, f"{layout.trusted_by_month}/month={month}")
    left = {r.month for r in found if r.now}
    if left:
        _replace_months(now.where(in_months), layout.trusted_sources)
    for month in set(months) - left:
        remove(spark, f"{layout.trusted_sources}/month={month}")
    return months


def _replace_months(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def take_in(spark: SparkSession, layout: Layout, settings: Settings) -> list[date]:
    """Land all arrivals, refresh the trusted table and clear out what is superseded; the
    months that were redone."""
    streams = [ingest(spark, layout, side, settings) for side in SIDES]
    for stream in streams:
        stream.awaitTermination()
    listings = listings_of(spark, layout)
    for side in SIDES:
        land_unknown(spark, layout, side, settings, listings[side])
    months = refresh_trusted(spark, layout, settings, listings)
    for side in SIDES:
        compact(spark, layout, side, settings, listings[side])
    return months


def catch_up(spark: SparkSession, layout: Layout, settings: Settings) -> DataFrame:
    """The trusted table with everything that has arrived."""
    take_in(spark, layout, settings)
    return trusted_by_month(spark, layout)


def trusted_by_month(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, layout.trusted_by_month, TRUSTED)


def trusted_state(spark: SparkSession, layout: Layout) -> tuple[int, int]:
    """Number and a checksum of the sources that the trusted table was built from."""
    row = read_or_empty(spark, layout.trusted_sources, MANIFEST).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64(*MANIFEST.fieldNames())), F.lit(0)).alias("mark"),
    ).first()
    return row.n, row.mark


def refined_state(spark: SparkSession, layout: Layout) -> tuple[int, int]:
    """The state that the refined tables were last made from; nothing yet is (0, 0)."""
    row = read_or_empty(spark, layout.refined_state, STATE).first()
    return (row.n, row.mark) if row else (0, 0)


def note_refined(spark: SparkSession, layout: Layout, state: tuple[int, int]) -> None:
    spark.createDataFrame([state], STATE).write.mode("overwrite").parquet(layout.refined_state)
