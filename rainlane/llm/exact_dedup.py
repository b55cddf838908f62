"""Stateful streaming exact deduplication.

Arrivals are reduced to narrow rows (digest, identifier, content locator) and read by
a checkpointed stream whose keyed state lives in RocksDB and never expires: per digest
the number of rows, and identifier and locator of the row that stays. The state is read
back with the engine's own state reader. A hit, that is a row whose digest the state
has for another row, is compared with the full bytes of the row that stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.llm.common import BLANKS, has_bit, place_in_files, settings, text_or_empty
from rainlane.staging import new_folder, stage

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Without it each partition's store reserves 4 MB of disk, however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
ARRIVAL = "digest string, id long, points long, file string, row long, size long"


def normalised(text: Column) -> Column:
    """The text without any blank; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


class StreamingDedup:
    """Exact deduplication of arrivals against everything that came before.

    ``folder`` holds the arrivals, the stream's checkpoint and the state; a later
    object with the same folder goes on where the last one stopped. Of equal texts the
    row with the most code points in the original text, then the smallest id, then the
    first place in its file stays; a later and longer arrival can take over.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        digest: Callable[[Column], Column] = sha256,
        files_per_batch: int = 4096,
        bitmaps_at_once: int = 8192,
    ):
        self.spark, self.digest, self.files_per_batch = spark, digest, files_per_batch
        self.bitmaps_at_once = bitmaps_at_once
        self.folder = folder or new_folder(spark, "streaming-dedup")
        self.arrivals, self.checkpoint = f"{self.folder}/arrivals", f"{self.folder}/stream"

    def add(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> None:
        """Take in a table read from files. Call it once per arrival.

        Null text counts as empty, a null id as larger than all others; repeated rows
        are copies of one another. Other columns are not read.
        """
        text = F.col(text_column)
        file, row = place_in_files(docs)
        docs.select(
            self.digest(normalised(text)).alias("digest"),
            F.col(id_column).cast("long").alias("id"),
            F.char_length(text_or_empty(text)).cast("long").alias("points"),
            file.alias("file"),
            row.alias("row"),
            F.octet_length(text_or_empty(text)).cast("long").alias("size"),
        ).write.mode("append").parquet(self.arrivals)
        self._run()

    def _run(self) -> None:
        with settings(self.spark, ROCKSDB):
            rows = (
                self.spark.readStream.schema(ARRIVAL)
                .option("maxFilesPerTrigger", self.files_per_batch)
                .parquet(self.arrivals)
            )
            state = rows.groupBy("digest").agg(
                F.count(F.lit(1)).alias("n"), F.max(_preference()).alias("best")
            )
            stream = (
                state.writeStream.format("noop")
                .outputMode("update")
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            stream.awaitTermination()

    def rows(self) -> DataFrame:
        """All rows taken in: digest, id, points, file, row, size."""
        return self.spark.read.schema(ARRIVAL).parquet(self.arrivals)

    def state(self) -> DataFrame:
        """What is retained: digest, n, keep_id, keep_file, keep_row."""
        value = F.col("value")
        state = self.spark.read.format("statestore").load(self.checkpoint)
        count, best = state.schema["value"].dataType.names
        return state.select(
            F.col("key.digest").alias("digest"),
            value[count].alias("n"),
            value[best]["id"].alias("keep_id"),
            value[best]["file"].alias("keep_file"),
            (-value[best]["backwards"]).alias("keep_row"),
        )

    def _texts_of(self, hits: DataFrame, contents: DataFrame, text_column: str) -> DataFrame:
        """Columns file, row and content of the rows of ``contents`` that are hits.

        A bit per row says which are, so no other text leaves its scan, whatever the size of
        the table. The bitmaps, one for 32,768 rows of a file, are broadcast, at most
        ``bitmaps_at_once`` of 4 KB at a time; where there are more, each part of the files
        is scanned with its own.
        """
        rows_each = 1 << 15
        bitmaps = stage(
            hits.groupBy("file", F.floor(F.col("row") / rows_each).alias("stretch")).agg(
                F.bitmap_construct_agg(F.pmod("row", F.lit(rows_each))).alias("bits")
            ),
            "dedup-bitmaps",
        )
        passes = max(1, -(-bitmaps.count() // self.bitmaps_at_once))
        file, row = place_in_files(contents)
        texts = contents.select(file.alias("file"), row.alias("row"), F.col(text_column).alias("content"))

        def part(frame: DataFrame, k: int) -> DataFrame:
            return frame if passes == 1 else frame.where(F.pmod(F.xxhash64("file"), F.lit(passes)) == k)

        found = [
            part(texts, k)
            .withColumn("stretch", F.floor(F.col("row") / rows_each))
            .join(F.broadcast(part(bitmaps, k)), ["file", "stretch"])
            .where(has_bit(F.col("bits"), F.pmod("row", F.lit(rows_each))))
            .select("file", "row", "content")
            for k in range(passes)
        ]
        return reduce(DataFrame.unionByName, found)

    def decisions(self, contents: DataFrame, text_column: str = "text") -> DataFrame:
        """Per row taken in: digest, id, file, row, keep_id, group_size, kept.

        ``contents`` is the table, read from files, that locators point into. Texts are
        compared byte by byte with the text that stays; should a digest hold different
        texts, its rows are grouped anew by the text itself.
        """
        rows, state = self.rows(), stage(self.state(), "dedup-state")
        hits = rows.join(state.where("n > 1"), "digest").select(
            "digest", "id", "points", "file", "row", "keep_file", "keep_row"
        )
        hits = stage(hits, "dedup-hits")
        texts = self._texts_of(hits, contents, text_column)
        texts = hits.join(texts, ["file", "row"]).withColumn("content", normalised(F.col("content")))
        texts = stage(texts, "dedup-texts")
        stays = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
        first = texts.where(stays).select("digest", F.col("content").alias("first"))
        differ = (
            texts.where(~stays)
            .join(first, "digest")
            .where("content <> first")
            .select("digest")
        )
        # Written first: a join that has to keep keys together could not split a hot one.
        differ = stage(differ, "dedup-collisions").distinct()
        own = ["digest", "id", "file", "row"]
        collided = texts.join(differ, "digest", "left_semi")
        split = collided.groupBy("digest", "content").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(_preference()).alias("best")
        )
        anew = collided.join(split, ["digest", "content"]).select(
            *own,
            F.col("best.id").alias("keep_id"),
            "group_size",
            ((F.col("file") == F.col("best.file")) & (-F.col("row") == F.col("best.backwards"))).alias("kept"),
        )
        plain = rows.join(state, "digest").select(*own, "keep_id", F.col("n").alias("group_size"), stays.alias("kept"))
        return plain.join(differ, "digest", "left_anti").unionByName(anew)


def _preference() -> Column:
    """Greatest for the row that stays."""
    return F.struct(
        "points",
        F.coalesce(-F.col("id"), F.lit(-(2**63))).alias("smallest"),
        "id",
        "file",
        (-F.col("row")).alias("backwards"),
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Decisions for a table read from files, as one arrival. An empty table gives no rows."""
    dedup = StreamingDedup(docs.sparkSession)
    dedup.add(docs, id_column, text_column)
    return dedup.decisions(docs, text_column)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    gone = exact_dedup(docs, id_column, text_column).where(~F.col("kept")).select("file", "row")
    file, row = place_in_files(docs)
    own = docs.select(F.struct("*").alias("own"), file.alias("file"), row.alias("row"))
    return own.join(gone, ["file", "row"], "left_anti").select("own.*")
