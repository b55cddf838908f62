"""Similarity join of documents on word shingles (Jaccard), by prefix filtering.

Shingles have one order for all documents, rare ones first: by counters that all shingles
of all documents are counted into, then by hash. Two documents that are similar enough
share a shingle of both prefixes, so only prefixes are shuffled, by shingle. Documents with
equal sets are one node from the start.

Links are wanted for the groups they make, so a list of documents that share a prefix
shingle is not expanded into pairs. Each document is paired with a central one of the list;
what these pairs connect is found out, and only pairs of documents of a list that are not
connected by then are looked at one by one. Such a list is cut into bands of lengths and
these into tiles of a bounded number of documents, so a long list is the work of many tasks.
All pairs pass the length, positional and suffix filters, are made distinct, and are verified
once, on the whole sets.

The suffix filter cuts the range of hashes at fixed pivots and compares the parities of the
parts' sizes, where the usual one searches for pivots in the suffixes and compares the sizes.
The parities are of the whole set: they fit into 128 bytes that go with each document, and
hold whatever the first shingle in common is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainlane.llm.common import freeing, has_bit
from rainlane.llm.components import connected
from rainlane.llm.shingles import WordHashes, shingle_set
from rainlane.staging import stage

COUNTERS = 1 << 20
PIECE = 256
SKETCH = 16  # numbers of 64 bits
BITMAP = 1 << 26
TILE = 512  # documents of a list at either side of a tile, about
LAST = 2**63 - 1


def signature(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def scan_sets(docs: DataFrame, width: int) -> DataFrame:
    """Columns id, signature and n per row of ``docs`` (id, text), and piece and counters:
    at the end of each task how many of its shingles fell into each counter."""

    @freeing
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counters = WordHashes(), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            signatures, sizes = [], []
            for text in batch.column(1):
                own = shingle_set(hashes.of_text(text.as_py() or ""), width)
                np.add.at(counters, (own % np.uint64(COUNTERS)).astype(np.int64), np.uint32(1))
                signatures.append(signature(own))
                sizes.append(len(own))
            none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            columns = [batch.column(0), pa.array(signatures, pa.binary()), pa.array(sizes, pa.int64()), *none]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        pieces = counters.reshape(-1, PIECE)
        used = np.flatnonzero(pieces.any(axis=1))
        none = [pa.nulls(len(used), kind) for kind in (pa.int64(), pa.binary(), pa.int64())]
        content = [pieces[k].tobytes() for k in used]
        columns = [*none, pa.array(used.astype(np.int32)), pa.array(content, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "signature", "n", "piece", "counters"]
    schema = "id long, signature binary, n long, piece int, counters binary"
    return docs.mapInArrow(scanned, schema)


def total_counters(scanned: DataFrame) -> np.ndarray:
    """Sum of all tasks' counters. Their number is fixed, so what comes back is 8 MB."""

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for frame in frames:
            for piece, content in zip(frame["piece"], frame["counters"]):
                own = totals.setdefault(piece, np.zeros(PIECE, np.int64))
                own += np.frombuffer(content, np.uint32)
        content = [own.tobytes() for own in totals.values()]
        yield pd.DataFrame({"piece": list(totals), "counters": content})

    pieces = scanned.where("piece is not null").select("piece", "counters")
    # A reducer adds up what some 64 tasks have, as far as there are pieces.
    width = min(COUNTERS // PIECE, max(16, scanned.rdd.getNumPartitions() // 64))
    rows = pieces.repartition(width, "piece").mapInPandas(summed, "piece int, counters binary").collect()
    totals = np.zeros((COUNTERS // PIECE, PIECE), np.int64)
    for r in rows:
        totals[r.piece] = np.frombuffer(r.counters, np.int64)
    return totals.ravel()


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set similar enough: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def prefixes(docs: DataFrame, totals: np.ndarray, width: int, percent: int) -> DataFrame:
    """Columns id, signature, tokens (the prefix, rare ones first) and sketch: 1024 parts of
    all shingles, and for each a bit that says whether an odd number of the set's falls into
    it, for the suffix filter."""
    sent = docs.sparkSession.sparkContext.broadcast(totals)

    @freeing
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, totals = WordHashes(), sent.value
        for batch in batches:
            signatures, tokens, sketches = [], [], []
            for text in batch.column(1):
                own = shingle_set(hashes.of_text(text.as_py() or ""), width)
                order = np.lexsort((own, totals[(own % np.uint64(COUNTERS)).astype(np.int64)]))
                length = len(own) - needed(len(own), percent) + 1 if len(own) else 0
                tokens.append(own[order[:length]].view(np.int64))
                spread = np.bincount((own >> np.uint64(54)).astype(np.int64), minlength=64 * SKETCH)
                sketches.append(np.packbits((spread & 1).astype(bool)).view(np.int64))
                signatures.append(signature(own))
            columns = [
                batch.column(0),
                pa.array(signatures, pa.binary()),
                pa.array(tokens, pa.list_(pa.int64())),
                pa.array(sketches, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "signature", "tokens", "sketch"])

    return docs.mapInArrow(made, "id long, signature binary, tokens array<long>, sketch array<long>")


def near_enough(percent: int) -> Column:
    """The length and suffix filters for n_a, n_b, sketch_a and sketch_b.

    A shingle that only one of two sets has changes one bit, so the sets differ in at least
    as many shingles as the sketches do in bits. Sets that are similar enough overlap by at
    least percent * (n_a + n_b) / (100 + percent), and differ in what is left.
    """
    bits = sum(
        F.bit_count(F.col("sketch_a")[k].bitwiseXOR(F.col("sketch_b")[k])) for k in range(SKETCH)
    )
    total = F.col("n_a") + F.col("n_b")
    near = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    return near & (bits * (100 + percent) <= total * (100 - percent))


def _seen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of ``ids``, and few others, by a bitmap of fixed size (8 MB).
    It only spares a shuffle; a join decides."""
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP))
    bitmaps = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    placed = docs.withColumns({"bucket": F.bitmap_bucket_number(place), "position": F.bitmap_bit_position(place)})
    met = placed.join(F.broadcast(bitmaps), "bucket").where(has_bit(F.col("bits"), F.col("position")))
    return met.select(*docs.columns)


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The distinct ``pairs`` (a, b) whose whole sets are similar enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(ends.join(nodes, "node").select("node", "id", "signature"), "join-wanted")
    texts = _seen(docs, wanted).join(wanted, "id")

    @freeing
    def own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [
                signature(shingle_set(hashes.of_text(text or ""), width)) == said
                for text, said in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            kept = batch.filter(pa.array(found, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["node", "text"])

    # Rows may share an identifier, so the text of a node is the one with its signature.
    texts = texts.select("node", "text", "signature").mapInArrow(own_rows, "node long, text string")
    texts = stage(texts.dropDuplicates(["node"]), "join-texts")
    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    @freeing
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            last, one, found = None, None, []
            for node, text_a, text_b in zip(batch.column(0), batch.column(2), batch.column(3)):
                if node != last:
                    last, one = node, shingle_set(hashes.of_text(text_a.as_py() or ""), width)
                two = shingle_set(hashes.of_text(text_b.as_py() or ""), width)
                common = len(np.intersect1d(one, two, assume_unique=True))
                found.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(checked, "a long, b long")


def fits(percent: int, before: str = "0") -> Column:
    """The length and positional filters for n_a, n_b, at_a and at_b: two sets have ``before``
    shingles in common ahead of one at these places at most, and then what follows in both."""
    most = f"least(n_a, n_b, {before} + least(n_a - at_a, n_b - at_b))"
    return F.expr(f"100 * {most} >= {percent} * (n_a + n_b - {most})")


def tiled(lists: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The documents of ``lists`` (token, n, node and others), once as the a side and once as
    the b side of tiles: documents of a list meet in one tile (token, band, low, high) if their
    lengths may be similar enough, and otherwise in none.

    A band ends where the next starts, at 100 / ``percent`` times its least length, so similar
    lengths are in one band or in neighbouring ones. A document is in its own band and, as a
    guest, in the next. Documents of a band and its guests are dealt into chunks of about
    ``TILE``, and each two chunks, and each with itself, are a tile; two guests are left to
    their own band.
    """
    # A little wider than the ratio, so that rounding can't part similar lengths.
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-12
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("long")
    both = F.array(*[F.struct((own + k).alias("band"), F.lit(k == 1).alias("guest")) for k in (0, 1)])
    dealt = lists.withColumn("in", F.explode(both)).select(*lists.columns, "in.band", "in.guest")
    sizes = dealt.groupBy("token", "band").agg(
        F.count(F.lit(1)).alias("members"), F.bool_and("guest").alias("guests_only")
    )
    sizes = sizes.where("members > 1 and not guests_only")
    sizes = sizes.select("token", "band", F.ceil(F.col("members") / TILE).alias("chunks"))
    dealt = dealt.join(sizes, ["token", "band"]).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    kept = [c for c in lists.columns if c != "token"]

    def side(end: str, low: Column, high: Column) -> DataFrame:
        own = [F.col(c).alias(f"{c}_{end}") for c in [*kept, "guest"]]
        return dealt.select("token", "band", low.alias("low"), high.alias("high"), *own)

    chunk, others = F.col("chunk"), F.col("chunks") - 1
    left = side("a", chunk, F.explode(F.sequence(chunk, others)))
    return left, side("b", F.explode(F.sequence(F.lit(0).cast("long"), chunk)), chunk)


def _with_sizes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        own = nodes.select(
            F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}")
        )
        pairs = pairs.join(own, end)
    return pairs


def similar_groups(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, n_shingles and component_id per row of ``docs``.

    Documents whose shingle sets have 100 * intersection >= ``percent`` * union are linked;
    component_id is the smallest id reachable by links. Documents without words, null text
    included, are linked with nothing. A null id is larger than all others, and rows may
    share ids: each row is a document of its own. Other columns are not read. An empty
    table gives no rows.
    """
    ids = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id")
    docs = docs.select(ids, F.col(text_column).alias("text"))
    scanned = stage(scan_sets(docs, width), "join-scan")
    rows = scanned.where("piece is null").select("id", "signature", "n")
    firsts = rows.where("n > 0").groupBy("signature", "n").agg(F.min("id").alias("id"))
    firsts = stage(firsts.withColumn("node", F.monotonically_increasing_id()), "join-firsts")
    own = prefixes(docs, total_counters(scanned), width, percent)
    own = own.dropDuplicates(["id", "signature"])
    nodes = stage(own.join(firsts, ["id", "signature"]), "join-nodes")
    postings = nodes.select("node", "n", F.posexplode("tokens").alias("at", "token"))
    sized = nodes.select("node", "n", "sketch")

    check = partial(verify, nodes=firsts, docs=docs, width=width, percent=percent)
    # The document with the fewest rarer shingles before this one is the nearest to what a
    # list has in common, so the others are paired with it.
    first = F.min(F.struct("at", "node", "n")).alias("first")
    lists = postings.groupBy("token").agg(first, F.count(F.lit(1)).alias("long"))
    central = [F.col(f"first.{name}").alias(f"{name}_a") for name in ("node", "at", "n")]
    own = [F.col(name).alias(f"{name}_b") for name in ("node", "at", "n")]
    first_pairs = (
        postings.join(lists.where("long > 1"), "token")
        .select(*central, *own)
        # This may not be the first shingle they have in common: all before it may be so, too.
        .where((F.col("node_a") != F.col("node_b")) & fits(percent, before="least(at_a, at_b)"))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )
    first_pairs = _with_sizes(stage(first_pairs, "join-pairs"), sized)
    tried = stage(first_pairs.where(near_enough(percent)).select("a", "b"), "join-tried")
    links = stage(check(tried), "join-links")
    roots = connected(links)

    placed = stage(
        postings.join(lists.where("long > 1").select("token"), "token", "left_semi")
        .join(roots, "node", "left")
        .select("token", "node", "n", "at", F.coalesce("root", "node").alias("root")),
        "join-placed",
    )
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_lists = placed.join(mixed.where("low < high").select("token"), "token", "left_semi")
    open_lists = stage(open_lists.join(nodes.select("node", "sketch"), "node"), "join-open")
    left, right = tiled(open_lists, percent)
    # This shingle is taken as the first in common; where it isn't, the list of that one has the
    # pair. All filters are in the join, so that pairs that are far apart are never rows.
    once = F.expr("(low < high or node_a < node_b) and not (guest_a and guest_b)")
    apart = F.col("root_a") != F.col("root_b")
    rest = (
        left.join(right, ["token", "band", "low", "high"])
        .where(once & apart & fits(percent) & near_enough(percent))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    more = check(stage(rest, "join-rest"))
    roots = connected(links.unionByName(more))

    named = firsts.join(roots, "node", "left").select("signature", "id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = named.join(least, "root").select("signature", "component_id")
    found = rows.join(stage(classes, "join-classes"), "signature", "left")
    return found.select(
        F.nullif("id", F.lit(LAST)).alias("id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component_id", "id"), F.lit(LAST)).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, all columns as they are. Rows
    that share an id stay or go together."""
    groups = similar_groups(docs, id_column=id_column, text_column=text_column, **options)
    stays = groups.where("id <=> component_id").select(F.col("id").alias("_stays")).distinct()
    same = docs[id_column].cast("long").eqNullSafe(stays["_stays"])
    return docs.join(stays, same, "left_semi")
