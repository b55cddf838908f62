"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector o is rotated at random. Stored are the signs x of the rotated vector, scaled
to length 1, and the correction factor <x, o>. For another vector q, <x, q> / <x, o>
estimates <o, q> without bias, and how far it may be off is bounded with any confidence
that is asked for, from the correction factor and the dimension alone.

Signs along further random directions sort vectors into buckets, several tables of them, so that two
vectors at the threshold share a bucket of some table with a given chance; closer ones
nearly surely. Within a bucket all pairs are estimated from the codes. Only vectors with a
partner whose upper bound reaches the threshold have their components sent, and are
computed again, exactly. A pair is looked at in the first table that has it in one bucket,
and never leaves its task: what goes out is how many links each vector has, and the edges
of a forest that connects what the links connect.

Equal vectors are one from the start, and count as often as they occur, so that copies cost
nothing in the buckets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainlane.llm.components import connected
from rainlane.staging import stage

TILE, BLOCK = 512, 256
SIGMAS = 3.0
LEVELS = 127
PLACE = ["dim", "tab", "bucket", "tile"]


@lru_cache(maxsize=4)
def rotations(dim: int, count: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix and, beside it, ``count`` independent directions: those of one
    rotation depend on one another, and the chance to share a bucket would be less."""
    rng = np.random.default_rng([seed, dim])
    return np.hstack([np.linalg.qr(rng.normal(size=(dim, dim)))[0], rng.normal(size=(dim, count))])


def tables_for(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a bucket, so that a bucket has some 16 rows by chance, and number of tables,
    so that a pair at the threshold meets in one of them with chance ``recall``."""
    bits = min(max(math.ceil(math.log2(max(rows, 2))) - 4, 6), 48)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


class Coder:
    """Codes of unit vectors of one dimension."""

    def __init__(self, dim: int, bits: int, tables: int, seed: int):
        self.dim, self.bits, self.tables = dim, bits, tables
        self.turned = rotations(dim, bits * tables, seed)

    def code(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rotated vectors of the first rotation, correction factors, and buckets by table."""
        turned = vectors @ self.turned
        first = turned[:, : self.dim]
        factors = np.abs(first).sum(axis=1) / np.sqrt(self.dim)
        signs = turned[:, self.dim : self.dim + self.bits * self.tables] > 0
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        return first, factors, signs.reshape(len(vectors), self.tables, self.bits) @ weights


def unit_vectors(column: pa.Array) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors, and these vectors at length 1 in double precision."""
    lengths = column.value_lengths()
    whole = column.null_count == 0 and column.flatten().null_count == 0 and len(column) > 0
    if whole and lengths[0].as_py() and len(lengths.unique()) == 1:
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
        largest = np.abs(values).max(axis=1)
        places = np.flatnonzero(np.isfinite(largest) & (largest > 0))
        values = values[places] / largest[places, None]
        return places.tolist(), list(values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None])
    places, found = [], []
    for at, value in enumerate(column):
        if not value.is_valid or value.values.null_count or not len(value.values):
            continue
        vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
        largest = np.abs(vector).max()
        if np.isfinite(largest) and largest > 0:
            vector = vector / largest
            places.append(at)
            found.append(vector / np.sqrt(np.einsum("j,j->", vector, vector)))
    return places, found


def encode(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Columns row, dim, signs, factor, turned (8 bits each) and step, buckets, per usable
    vector of ``vectors`` (row, embedding), and digest, the same for equal vectors."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = unit_vectors(batch.column(1))
            rows = batch.column(0).to_numpy()[np.array(places, np.int64)]
            dims = np.array([len(v) for v in found], np.int64)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                first, factors, buckets = Coder(int(dim), bits, tables, seed).code(
                    np.array([found[i] for i in own])
                )
                step = np.abs(first).max(axis=1) / LEVELS
                turned = np.rint(first / step[:, None]).astype(np.int8)
                packed = np.packbits(first > 0, axis=1)
                columns = [
                    pa.array(rows[own]),
                    pa.array(np.full(len(own), dim, np.int32)),
                    pa.array([x.tobytes() for x in packed], pa.binary()),
                    pa.array(factors.astype(np.float32)),
                    pa.array([x.tobytes() for x in turned], pa.binary()),
                    pa.array(step.astype(np.float32)),
                    pa.array(list(buckets), pa.list_(pa.int64())),
                    pa.array([hashlib.blake2b(found[i] + 0.0, digest_size=16).digest() for i in own], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["row", "dim", "signs", "factor", "turned", "step", "buckets", "digest"]
    schema = (
        "row long, dim int, signs binary, factor float, turned binary, step float, buckets array<long>, digest binary"
    )
    return vectors.mapInArrow(encoded, schema)


def in_tiles(postings: DataFrame) -> DataFrame:
    """Rows of buckets (dim, tab, bucket, row, ...) with chunk and tile. A bucket of more than
    TILE rows is cut into chunks, and each pair of chunks is a tile, a task's work of its own."""
    key = PLACE[:3]
    large = postings.groupBy(*key).count().where(F.col("count") > TILE)
    large = stage(large.select(*key, F.ceil(F.col("count") / TILE).cast("int").alias("chunks")), "dedup-large")
    cut = postings.join(large, key, "left")
    chunk = F.when(F.col("chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.col("chunks")))
    cut = cut.withColumn("chunk", chunk.cast("int"))
    others = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
    spread = cut.withColumn("other", F.explode(others))
    tile = F.least("chunk", "other").cast("long") * (1 << 31) + F.greatest("chunk", "other")
    return spread.withColumn("tile", tile).drop("other", "chunks")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by PLACE, cut into blocks of whole runs, and the number of each row's run.
    A block has BLOCK rows at least, but for the last, and one run more at most."""
    held: list[pa.RecordBatch] = []

    def numbered(table: pa.RecordBatch) -> np.ndarray:
        columns = [table.column(table.schema.get_field_index(name)).to_numpy() for name in PLACE]
        new = np.zeros(table.num_rows, bool)
        for own in columns:
            new[1:] |= own[1:] != own[:-1]
        return np.cumsum(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_batches([*held, batch])
        runs = numbered(table)
        starts = np.append(0, np.flatnonzero(np.diff(runs)) + 1)
        at = 0
        while True:
            cut = starts[np.searchsorted(starts, at + BLOCK)] if starts[-1] >= at + BLOCK else None
            if cut is None:
                break
            yield table.slice(at, cut - at), runs[at:cut]
            at = cut
        held = [table.slice(at)]
    if held:
        table = pa.concat_batches(held)
        yield table, numbered(table)


def pairs_of(runs: np.ndarray, chunks: np.ndarray, tiles: np.ndarray) -> np.ndarray:
    """Which pairs (i < j) of a block's rows are to be compared: of one run, and in a tile of
    two chunks only across these."""
    same = np.triu(runs[:, None] == runs[None, :], 1)
    across = (tiles >> 31) != (tiles & (2**31 - 1))
    return same & ~(across[:, None] & (chunks[:, None] == chunks[None, :]))


def first_meeting(buckets: np.ndarray, i: np.ndarray, j: np.ndarray, tabs: np.ndarray) -> np.ndarray:
    """Pairs whose first table with a common bucket is the one they were met in."""
    if not len(i):
        return np.zeros(0, bool)
    return np.argmax(buckets[i] == buckets[j], axis=1) == tabs[i]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _lists(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def undecided(tiles: DataFrame, threshold: float) -> DataFrame:
    """PLACE, chunk and row of the vectors with a partner that may reach the threshold."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs in blocks(batches):
            wanted = pairs_of(runs, _column(batch, "chunk").to_numpy(), _column(batch, "tile").to_numpy())
            tabs = _column(batch, "tab").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            dims = _column(batch, "dim").to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(own))
                i, j = np.nonzero(wanted[np.ix_(own, own)] & may_reach(part, int(dim), threshold))
                buckets = _lists(_column(part, "buckets"), np.int64)
                met = first_meeting(buckets, i, j, tabs[own])
                keep[own[i[met]]] = keep[own[j[met]]] = True
            yield batch.select([*PLACE, "chunk", "row"]).filter(pa.array(keep))

    placed = tiles.select(*PLACE, "chunk", "row", "signs", "factor", "turned", "step", "buckets")
    dealt = placed.repartition(*PLACE).sortWithinPartitions(*PLACE)
    schema = "dim int, tab int, bucket long, tile long, chunk int, row long"
    return dealt.mapInArrow(compared, schema)


def may_reach(part: pa.RecordBatch, dim: int, threshold: float) -> np.ndarray:
    """Pairs for which one of both estimates, of either from the other's code, has an upper
    bound of the threshold or more."""
    signs = np.frombuffer(b"".join(_column(part, "signs").to_pylist()), np.uint8)
    signs = np.unpackbits(signs.reshape(part.num_rows, -1), axis=1)[:, :dim].astype(np.float32) * 2 - 1
    turned = np.frombuffer(b"".join(_column(part, "turned").to_pylist()), np.int8)
    step = _column(part, "step").to_numpy().astype(np.float32)
    factor = _column(part, "factor").to_numpy().astype(np.float32)
    turned = turned.reshape(part.num_rows, dim).astype(np.float32) * step[:, None]
    root = np.float32(math.sqrt(dim))
    estimate = signs @ turned.T / (root * factor[:, None])
    off = SIGMAS * np.sqrt(np.maximum(0, 1 - factor**2)) / (factor * math.sqrt(max(dim - 1, 1)))
    rounded = root * step / 2  # at most, from keeping eight bits of a component
    upper = estimate + off[:, None] + rounded[None, :] / factor[:, None]
    return np.maximum(upper, upper.T) >= threshold


def exact_links(survivors: DataFrame, threshold: float, bits: int, tables: int, seed: int) -> DataFrame:
    """Per tile and vector (row, embedding, copies and PLACE): n_links, by how many copies its
    partners have, and root, a smaller or the same row that it is connected with by links of
    the tile."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs in blocks(batches):
            rows = _column(batch, "row").to_numpy()
            wanted = pairs_of(runs, _column(batch, "chunk").to_numpy(), _column(batch, "tile").to_numpy())
            tabs, dims = _column(batch, "tab").to_numpy(), _column(batch, "dim").to_numpy()
            links, root = np.zeros(len(rows), np.int64), rows.copy()
            copies = _column(batch, "copies").to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                _, found = unit_vectors(_column(batch, "embedding").take(pa.array(own)))
                vectors = np.array(found)
                i, j = np.nonzero(wanted[np.ix_(own, own)] & (vectors @ vectors.T >= threshold))
                _, _, buckets = Coder(int(dim), bits, tables, seed).code(vectors)
                met = first_meeting(buckets, i, j, tabs[own])
                i, j = own[i[met]], own[j[met]]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                while len(i):
                    least = np.minimum(root[i], root[j])
                    if (root[i] == least).all() and (root[j] == least).all():
                        break
                    np.minimum.at(root, i, least)
                    np.minimum.at(root, j, least)
            out = np.flatnonzero(links)
            columns = [pa.array(x[out]) for x in (rows, links, root)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_links", "root"])

    dealt = survivors.repartition(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.mapInArrow(computed, "row long, n_links long, root long")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.999,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    seed: int = 11,
) -> DataFrame:
    """Columns id, n_links, component_id and kept per row of ``vectors``.

    Rows with a cosine of ``threshold`` or more, in double precision, are linked; a link at
    the threshold itself is found with chance ``recall``, and no link is below it. Equal
    vectors are always linked. Vectors
    that are null, empty or zero, or hold null or non-finite components, link with nothing;
    vectors of different dimensions aren't compared. Each row is a vector of its own, also
    where ids are shared; a null id is larger than all others. Of the rows of a component
    with its smallest id one is kept if ids differ. Other columns are not read.
    """
    given = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).alias("embedding"),
    )
    given = stage(given, "dedup-vectors")
    bits, tables = tables_for(given.count(), threshold, recall)
    codes = stage(encode(given.select("row", "embedding"), bits, tables, seed), "dedup-codes")
    classes = codes.groupBy("digest").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes, "dedup-classes")
    firsts = codes.join(classes.select(F.col("first").alias("row")), "row", "left_semi").drop("digest")
    postings = firsts.select("*", F.posexplode("buckets").alias("tab", "bucket"))
    survivors = stage(undecided(in_tiles(postings), threshold), "dedup-survivors")
    sized = classes.select(F.col("first").alias("row"), "copies")
    whole = survivors.join(given.select("row", "embedding"), "row").join(sized, "row")
    links = stage(exact_links(whole, threshold, bits, tables, seed), "dedup-links")
    counts = links.groupBy("row").agg(F.sum("n_links").alias("n_links"))
    roots = connected(links.select(F.col("row").alias("a"), F.col("root").alias("b")))
    none = F.lit(0).cast("long")
    found = (
        classes.withColumnRenamed("first", "row")
        .join(counts, "row", "left")
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .select(
            "digest",
            (F.coalesce("n_links", none) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "row").alias("root"),
        )
    )
    found = codes.select("row", "digest").join(found, "digest").drop("digest")
    named = given.select("row", "id").join(found, "row", "left").select(
        "row", "id", F.coalesce("n_links", none).alias("n_links"), F.coalesce("root", "row").alias("root")
    )
    named = stage(named, "dedup-named")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(least, "root").select(
        "id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
