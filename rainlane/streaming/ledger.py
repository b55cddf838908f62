"""What has been landed of which raw file, batch by batch.

Each batch of arrivals is a folder of rows, one of rejected input, and one small file of the
ledger, written last: a batch without it isn't there. It says how many rows each version of a
file gave to each month, so neither a refresh nor a compaction has to look into landed rows to
find out what they hold. A batch that is landed again overwrites itself. A batch that took the
place of others names them, and they stay void even if one of them is landed again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainlane.schemas import DATE, FILE_VERSION, LONG, TEXT, struct
from rainlane.settings import Layout
from rainlane.staging import is_there, remove

VERSION = FILE_VERSION.fieldNames()
SIDES = ("incidents", "weather")
ENTRY = T.StructType([*FILE_VERSION.fields, *struct(month=DATE, n_rows=LONG, n_rejected=LONG).fields])
LEDGER = T.StructType([*ENTRY.fields, *struct(replaces=T.ArrayType(TEXT), batch=TEXT).fields])
REJECTED = T.StructType([*FILE_VERSION.fields, *struct(record=TEXT, batch=TEXT).fields])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or an empty one where it isn't written yet."""
    if not is_there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def batch_folder(path: str, batch: str) -> str:
    return f"{path}/batch={batch}"


def note(entries: DataFrame, layout: Layout, side: str, batch: str, replaces: list[str] | None = None) -> None:
    """Write the ledger's file of a batch, which makes the batch count. A row without a file
    says which batches it takes the place of."""
    named = F.array(*[F.lit(one) for one in replaces or []]).cast("array<string>")
    none = F.lit(None)
    own = entries.sparkSession.range(1).select(*[none.cast(f.dataType).alias(f.name) for f in ENTRY.fields])
    marked = own.withColumn("replaces", named)
    entries = entries.select(*ENTRY.fieldNames()).withColumn("replaces", none.cast("array<string>")).unionByName(marked)
    entries.coalesce(1).write.mode("overwrite").parquet(batch_folder(layout.ledger(side), batch))


def entries_of(spark: SparkSession, layout: Layout, side: str) -> DataFrame:
    return read_or_empty(spark, layout.ledger(side), LEDGER)


def landed_files(spark: SparkSession, layout: Layout, side: str) -> DataFrame:
    """The ledger without void batches: a row per batch, version of a file and month. Of a
    version that was landed twice, as a file may be that came between stream and listing, the
    first batch counts."""
    entries = entries_of(spark, layout, side)
    void = entries.select(F.explode("replaces").alias("batch")).distinct()
    entries = entries.join(void, "batch", "left_anti")
    first = entries.groupBy(*VERSION).agg(F.min("batch").alias("batch"))
    return entries.join(first, [*VERSION, "batch"], "left_semi")


def live_files(spark: SparkSession, layout: Layout, side: str, listing: DataFrame) -> DataFrame:
    """The same for versions that lie in the raw zone now, by its ``listing``."""
    return landed_files(spark, layout, side).join(listing, VERSION, "left_semi")


def arrival_counts(spark: SparkSession, layout: Layout, listings: dict[str, DataFrame]) -> DataFrame:
    """Columns stage and n_rows: files, landed and rejected rows of each side, from the ledger."""
    parts = []
    for side in SIDES:
        live = live_files(spark, layout, side, listings[side])
        sums = live.agg(
            F.count_distinct(*VERSION).alias("files"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("n_rejected"), F.lit(0)).alias("rejected"),
        )
        stages = [F.struct(F.lit(f"{side}_{name}").alias("stage"), F.col(name).alias("n_rows")) for name in sums.columns]
        parts.append(sums.select(F.inline(F.array(*stages))))
    return reduce(DataFrame.unionByName, parts)


def rejected(spark: SparkSession, layout: Layout, side: str, listing: DataFrame) -> DataFrame:
    """Input that could not be read, of files that are still there as they were: source_file,
    source_time, record."""
    live = live_files(spark, layout, side, listing).where("n_rejected > 0")
    rows = read_or_empty(spark, layout.rejected(side), REJECTED)
    return rows.join(live, [*VERSION, "batch"], "left_semi").drop("batch")


def forget(spark: SparkSession, layout: Layout, side: str, batches: list[str]) -> None:
    """Delete batches that another one has taken the place of."""
    for batch in batches:
        for path in (layout.landed(side), layout.rejected(side), layout.ledger(side)):
            remove(spark, batch_folder(path, batch))
