"""Incremental and reversible line dedup.

What is retained of the documents are postings (key of a line, document), exact
reference counts (key: documents that hold it, the largest of them), and one cuckoo
filter per shard of keys, over the keys that are frequent. Documents can be taken in and
taken back at any time: counts are worked out anew for the keys that changed, and keys
that become frequent, or stop being so, are put into or taken out of their shard's
filter. The filters tell most lines of a document apart from frequent ones without a
look at the counts; what they let through is decided by the counts alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.llm.common import with_row
from rainlane.llm.cuckoo import CuckooFilter, Full
from rainlane.staging import new_folder

STRIPPED = b" \t\n\x0b\x0c\r"
KEY = ["shard", "high", "low"]
COUNTS = "shard int, high long, low long, n long, last_known boolean, last long"
FILTERS = "shard int, content binary"


def line_key(line: bytes, min_points: int) -> tuple[int, int] | None:
    """128 bits of a hash of the stripped line with A-Z in lower case; None if it is short."""
    key = line.strip(STRIPPED).lower()
    if len(key) < min_points:
        return None
    if len(key) < 4 * min_points and len(key.decode("utf-8", "surrogatepass")) < min_points:
        return None
    digest = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class LineIndex:
    """Postings, counts and filters in ``folder``; a later object goes on with them.

    A null identifier is a document of its own, smaller than all others. Rows with the
    same identifier are one document. A null text is one empty line. Each change is
    written as a new version next to the last, so a change that fails leaves the index
    as it was.

    ``shards`` is fixed for an index. The frequent keys of one shard, and the filter over
    them, are one task's work, so there should be a shard for every million or so. Above
    ``filter_bytes`` for all filters together they are not broadcast, and all postings go to
    the join with the counts; the result is the same.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        version: int = 0,
        min_points: int = 40,
        min_documents: int = 5,
        shards: int = 64,
        filter_bytes: int = 256 << 20,
    ):
        self.spark, self.folder = spark, folder or new_folder(spark, "line-index")
        self.version = version
        self.min_points, self.min_documents = min_points, min_documents
        self.shards, self.filter_bytes = shards, filter_bytes

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/v{self.version}/{name}")

    def postings(self) -> DataFrame:
        return self._read("postings", "shard int, high long, low long, known boolean, id long")

    def counts(self) -> DataFrame:
        """Per key the number of its documents and the last of them."""
        return self._read("counts", COUNTS)

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS)

    def _lines(self, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
        """The distinct keys of each row."""
        min_points, shards = self.min_points, self.shards

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    keys, ids = [], []
                    for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        own = {line_key(x, min_points) for x in _lines_of(text)} - {None}
                        keys += own
                        ids += [key] * len(own)
                    halves = np.array(keys, np.int64).reshape(-1, 2)
                    ids = pa.array(ids, pa.int64())
                    columns = [
                        pa.array((halves[:, 0] % shards).astype(np.int32)),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                        ids.is_valid(),
                        ids.fill_null(0),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "known", "id"])

        own = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        schema = "shard int, high long, low long, known boolean, id long"
        # Two steps, so that a key in very many documents is never one task's work.
        return own.mapInArrow(keyed, schema).distinct()

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> None:
        """Take documents in. A document that is there already gets the lines added."""
        new = self._lines(docs, id_column, text_column)
        self._advance(new if not self.version else self.postings().unionByName(new).distinct())

    def delete(self, ids: DataFrame, id_column: str = "doc_id") -> None:
        """Take back all lines of the documents with these identifiers."""
        own = ids.select(F.col(id_column).cast("long").alias("id"))
        gone = own.select(
            F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0)).alias("id")
        ).distinct()
        self._advance(self.postings().join(gone, ["known", "id"], "left_anti"))

    def _advance(self, postings: DataFrame) -> None:
        path = f"{self.folder}/v{self.version + 1}"
        old_counts, old_filters = self.counts(), self.filters()
        schema = postings.schema
        postings.write.mode("overwrite").parquet(f"{path}/postings")
        counts = (
            self.spark.read.schema(schema)
            .parquet(f"{path}/postings")
            .groupBy(*KEY)
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("known", "id")).alias("last"))
            .select(*KEY, "n", F.col("last.known").alias("last_known"), F.col("last.id").alias("last"))
        )
        counts.write.mode("overwrite").parquet(f"{path}/counts")
        counts = self.spark.read.schema(COUNTS).parquet(f"{path}/counts")
        frequent = F.col("n") >= self.min_documents
        now = counts.where(frequent).select(*KEY)
        before = old_counts.where(frequent).select(*KEY)
        changes = (
            now.join(before, KEY, "left_anti").withColumn("added", F.lit(True))
        ).unionByName(before.join(now, KEY, "left_anti").withColumn("added", F.lit(False)))
        changed = changes.groupBy("shard").cogroup(old_filters.groupBy("shard"))
        filters = changed.applyInPandas(_update_filter, FILTERS)
        # A shard whose filter is full is built anew from the exact counts.
        filters.write.mode("overwrite").parquet(f"{path}/updated")
        updated = self.spark.read.schema(FILTERS).parquet(f"{path}/updated")
        overfull = updated.where("content is null").select("shard")
        rebuilt = (
            now.join(F.broadcast(overfull), "shard", "left_semi").groupBy("shard").applyInPandas(_build_filter, FILTERS)
        )
        updated.where("content is not null").unionByName(rebuilt).write.mode("overwrite").parquet(
            f"{path}/filters"
        )
        self.version += 1

    def _maybe_frequent(self):
        """A test of (shard, high) by the filters, or None where they are larger than allowed."""
        size = self.filters().agg(F.sum(F.length("content"))).first()[0] or 0
        if size > self.filter_bytes:
            return None
        content = {r.shard: bytes(r.content) for r in self.filters().collect()}
        sent = self.spark.sparkContext.broadcast(content)

        @F.pandas_udf("boolean")
        def maybe(shards: pd.Series, highs: pd.Series) -> pd.Series:
            found = np.zeros(len(shards), bool)
            values, own = highs.to_numpy(), shards.to_numpy()
            for shard in np.unique(own):
                if shard in sent.value:
                    at = np.flatnonzero(own == shard)
                    found[at] = CuckooFilter.from_bytes(sent.value[shard]).contains(values[at])
            return pd.Series(found)

        return maybe

    def dropped(self) -> DataFrame:
        """Keys that each document loses: known, id, keys (array of both halves)."""
        postings, maybe = self.postings(), self._maybe_frequent()
        if maybe is not None:
            postings = postings.where(maybe("shard", "high"))
        frequent = self.counts().where(F.col("n") >= self.min_documents)
        lost = postings.join(frequent, KEY).where("id <> last or known <> last_known")
        return lost.groupBy("known", "id").agg(
            F.collect_list(F.struct("high", "low")).alias("keys")
        )

    def clean(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Columns row (all columns of ``docs``), n_lines, n_dropped and kept_text.

        A frequent line stays in the last document that holds it only. Documents that
        the index doesn't have keep all their lines. An empty table gives no rows.
        """
        min_points = self.min_points
        own = docs.select(
            F.struct("*").alias("row"),
            F.col(text_column).alias("text"),
            F.col(id_column).isNotNull().alias("known"),
            F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("id"),
        )
        given = own.join(self.dropped(), ["known", "id"], "left").select("row", "text", "keys")

        def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines, losses, texts = [], [], []
                for text, keys in zip(batch.column(1), batch.column(2)):
                    gone = {(k["high"], k["low"]) for k in keys.as_py() or ()}
                    all_lines = _lines_of(text.as_py())
                    kept = all_lines
                    if gone:
                        kept = [x for x in all_lines if line_key(x, min_points) not in gone]
                    lines.append(len(all_lines))
                    losses.append(len(all_lines) - len(kept))
                    texts.append(b"\n".join(kept))
                columns = [
                    batch.column(0),
                    pa.array(lines, pa.int64()),
                    pa.array(losses, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "n_lines", "n_dropped", "kept_text"])

        return given.mapInArrow(cleaned, with_row(given, "n_lines long, n_dropped long, kept_text string"))


def _lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def _update_filter(key: tuple, changes: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after its changes; null content if it can't hold them."""
    added = changes["added"].to_numpy(bool)
    highs = changes["high"].to_numpy(np.int64)
    try:
        if len(old):
            own = CuckooFilter.from_bytes(old["content"].iloc[0])
            own.delete(highs[~added])
            own.insert(highs[added])
        else:
            own = CuckooFilter.of(highs[added])
        content = own.to_bytes()
    except Full:
        content = None
    return pd.DataFrame({"shard": [key[0]], "content": [content]})


def _build_filter(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
    content = CuckooFilter.of(keys["high"].to_numpy(np.int64)).to_bytes()
    return pd.DataFrame({"shard": [key[0]], "content": [content]})


def shards_for(docs: DataFrame, text_column: str, min_points: int, min_documents: int) -> int:
    """So many shards that none has over a million frequent keys: each of these takes up at
    least ``min_points`` bytes in ``min_documents`` documents."""
    size = docs.agg(F.sum(F.octet_length(text_column).cast("long"))).first()[0] or 0
    return max(64, size // (max(1, min_points) * max(1, min_documents) * 1_000_000))


def drop_repeated_lines(
    docs: DataFrame, min_points: int = 40, min_documents: int = 5, shards: int | None = None, **options
) -> DataFrame:
    """``LineIndex.clean`` of a table by an index of the same table."""
    shards = shards or shards_for(docs, "text", min_points, min_documents)
    index = LineIndex(docs.sparkSession, min_points=min_points, min_documents=min_documents, shards=shards, **options)
    index.insert(docs)
    return index.clean(docs)
