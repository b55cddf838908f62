"""Arrival-driven ingest: each version of a raw file is read exactly once."""

from __future__ import annotations

import hashlib
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rainlane.operators.unpack import unpack_days
from rainlane.plans.trusted import typed_incidents
from rainlane.schemas import FILE_VERSION, INCIDENTS, TEXT, WEATHER_DAYS, landed
from rainlane.settings import Layout, Settings
from rainlane.sources.documents import read_weather_documents, stream_weather_documents
from rainlane.sources.extracts import read_extract, stream_extract
from rainlane.sources.raw_files import CORRUPT, file_versions
from rainlane.staging import stage
from rainlane.streaming.ledger import (
    ENTRY,
    REJECTED,
    VERSION,
    batch_folder,
    entries_of,
    forget,
    landed_files,
    live_files,
    note,
    read_or_empty,
)

LANDED = {"incidents": landed(INCIDENTS), "weather": landed(WEATHER_DAYS)}


def month_of() -> Column:
    return F.trunc("date", "month")


def raw_path(layout: Layout, side: str) -> str:
    return layout.raw_incidents if side == "incidents" else layout.raw_weather


def list_raw(spark: SparkSession, layout: Layout, side: str) -> DataFrame:
    """The versions of the raw files as they are now, listed once and written down.

    Names with a character of a glob raise: a stream reads rows of other files twice where a
    batch has such a file.
    """
    listing = stage(file_versions(spark, raw_path(layout, side)), f"listing-{side}")
    odd = listing.where(F.url_decode("source_file").rlike(r"[\[\]{}*?]")).first()
    if odd:
        raise ValueError(f"raw file names must not have any of []{{}}*?: {odd.source_file}")
    return listing


def typed(side: str, raw: DataFrame, settings: Settings) -> DataFrame:
    """Rows as they are landed, from a scan of raw files with their versions."""
    rows = typed_incidents(raw, settings) if side == "incidents" else unpack_days(raw, VERSION)
    return rows.withColumn("month", month_of()).select(*LANDED[side].fieldNames())


def land_batch(
    raw: DataFrame, layout: Layout, side: str, settings: Settings, batch: str, files: DataFrame | None = None
) -> None:
    """Write the rows of a batch by month, what could not be read apart from them, and then its
    part of the ledger. ``files``: versions that are in the ledger even if they have no row."""
    spark, apart = raw.sparkSession, CORRUPT in raw.columns
    landed_at = batch_folder(layout.landed(side), batch)
    if apart:
        raw = raw.persist()  # read once for both outputs
    sound = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if apart else raw
    typed(side, sound, settings).write.mode("overwrite").partitionBy("month").parquet(landed_at)
    rows = spark.read.schema(LANDED[side]).parquet(landed_at)
    none = F.lit(0).cast("bigint")
    entries = [rows.groupBy(*VERSION, "month").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_rejected", none)]
    if apart:
        rejected_at = batch_folder(layout.rejected(side), batch)
        bad = raw.where(F.col(CORRUPT).isNotNull()).select(*VERSION, F.col(CORRUPT).alias("record"))
        bad.write.mode("overwrite").parquet(rejected_at)
        bad = spark.read.schema(T.StructType(REJECTED.fields[:-1])).parquet(rejected_at)
        entries.append(bad.groupBy(*VERSION).agg(F.count(F.lit(1)).alias("n_rejected")).withColumn("n_rows", none))
        raw.unpersist()
    if files is not None:
        entries.append(files.select(*VERSION, none.alias("n_rows"), none.alias("n_rejected")))
    month = F.lit(None).cast("date").alias("month")
    entries = [e if "month" in e.columns else e.select("*", month) for e in entries]
    note(reduce(DataFrame.unionByName, entries).select(*ENTRY.fieldNames()), layout, side, batch)


def ingest(spark: SparkSession, layout: Layout, side: str, settings: Settings) -> StreamingQuery:
    """Land what has arrived since the last time, and stop. The checkpoint remembers the files
    already read; a batch that is repeated overwrites what it wrote."""
    limit, corrupt = settings.files_per_batch, settings.corrupt_mode
    if side == "incidents":
        raw = stream_extract(spark, layout.raw_incidents, files_per_batch=limit, sources=True, corrupt=corrupt)
    else:
        raw = stream_weather_documents(spark, layout.raw_weather, limit, sources=True, corrupt=corrupt)

    def land(rows: DataFrame, number: int) -> None:
        land_batch(rows, layout, side, settings, f"s{number:09d}")

    stream = raw.writeStream.foreachBatch(land).option("checkpointLocation", layout.checkpoint(side))
    return stream.trigger(availableNow=True).start()


def ingest_incidents(spark: SparkSession, layout: Layout, settings: Settings) -> StreamingQuery:
    return ingest(spark, layout, "incidents", settings)


def ingest_weather(spark: SparkSession, layout: Layout, settings: Settings) -> StreamingQuery:
    return ingest(spark, layout, "weather", settings)


def land_unknown(spark: SparkSession, layout: Layout, side: str, settings: Settings, listing: DataFrame) -> None:
    """Land versions of files that the stream passed over: files written anew under a name that
    was read before, which a stream takes once, and files without a row.

    Their names come to the driver, as the names of all files of a scan do.
    """
    known = landed_files(spark, layout, side).select(*VERSION)
    found = listing.join(known, VERSION, "left_anti").collect()
    versions = sorted((r.source_file, str(r.source_time)) for r in found)
    if not versions:
        return
    unknown = spark.createDataFrame(found, FILE_VERSION)
    paths = [unquote(name) for name, _ in versions]
    if side == "incidents":
        raw = read_extract(spark, paths, corrupt=settings.corrupt_mode, sources=True)
    else:
        raw = read_weather_documents(spark, paths, corrupt=settings.corrupt_mode, sources=True)
    # The same files again make the same batch, so a run that failed on the way is overwritten.
    mark = hashlib.sha256(repr(versions).encode()).hexdigest()[:24]
    land_batch(raw, layout, side, settings, f"u{mark}", files=unknown)


def landed_rows(
    spark: SparkSession,
    layout: Layout,
    side: str,
    files: DataFrame | None = None,
    batches: list[str] | None = None,
) -> DataFrame:
    """Rows of the batches that count, or of the versions in ``files`` alone. Their batches
    are named to the scan, so that it looks into no other."""
    files = landed_files(spark, layout, side) if files is None else files
    if batches is None:
        batches = [r.batch for r in files.select("batch").distinct().collect()]
    schema = T.StructType([*LANDED[side].fields, T.StructField("batch", TEXT)])
    rows = read_or_empty(spark, layout.landed(side), schema).where(F.col("batch").isin(batches))
    return rows.join(files.select("batch", *VERSION).distinct(), ["batch", *VERSION], "left_semi").select(
        *LANDED[side].fieldNames()
    )


def compact(spark: SparkSession, layout: Layout, side: str, settings: Settings, listing: DataFrame) -> bool:
    """Rewrite the batches that hold rows of files that are gone or were written anew, without
    these rows, once there are more than ``settings.dead_share`` of the live ones.

    The new batch counts, and the old ones don't, from the moment its ledger is written; a run
    that fails before leaves all as it was, and one that fails after leaves folders that
    the next one deletes.
    """
    files = landed_files(spark, layout, side)
    counted = files.join(listing.withColumn("alive", F.lit(True)), VERSION, "left").agg(
        F.coalesce(F.sum(F.when(F.col("alive"), F.col("n_rows"))), F.lit(0)).alias("live"),
        F.coalesce(F.sum(F.when(F.col("alive").isNull(), F.col("n_rows"))), F.lit(0)).alias("dead"),
    ).first()
    if counted.dead <= settings.dead_share * counted.live:
        return False
    files = stage(files, "ledger")
    live = stage(files.join(listing, VERSION, "left_semi"), "ledger-live")
    dead = files.join(live, [*VERSION, "batch"], "left_anti").select("batch").distinct()
    touched = sorted(r.batch for r in dead.collect())
    own = entries_of(spark, layout, side).where(F.col("batch").isin(touched))
    before = own.select(F.explode("replaces").alias("batch")).distinct()
    replaces = sorted({*touched, *(r.batch for r in before.collect())})
    batch = f"c{hashlib.sha256(repr(replaces).encode()).hexdigest()[:24]}"
    kept = live.where(F.col("batch").isin(touched))
    rows = landed_rows(spark, layout, side, kept).hint("rebalance", "month")
    rows.write.mode("overwrite").partitionBy("month").parquet(batch_folder(layout.landed(side), batch))
    bad = read_or_empty(spark, layout.rejected(side), REJECTED)
    bad = bad.join(kept.where("n_rejected > 0"), [*VERSION, "batch"], "left_semi").drop("batch")
    bad.write.mode("overwrite").parquet(batch_folder(layout.rejected(side), batch))
    note(kept, layout, side, batch, replaces)
    forget(spark, layout, side, replaces)
    return True
