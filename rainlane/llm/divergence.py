"""How far the sources of a language are from one another, by a quadtree over their terms.

The counts of a language's kept terms (columns) in its groups, one per source (rows), are a
sparse matrix. A K-squared tree holds it: a square of cells is cut into K x K squares, those
without a count are left out, and the leaves, of ``LEAF`` x ``LEAF`` cells, hold their counts.
Pairs of rows of squares go down the tree together, level by level as joins with the
squares of that level: where neither has a square, all its terms have the price that a count
of 0 has in either group, so their number is enough; where one has, the traversal goes
on, and at the leaves the prices are compared cell by cell, many leaves at a time.

A price is 1 + floor(10^9 * (count + 5) / (N + 5 * V)), N the group's counts of kept terms
and V the number of kept terms, in whole numbers throughout.

Null text, language and source count as empty texts. Repeated rows are documents of their
own. A group without terms is a row of zeros. An empty table has no groups.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainlane.llm.common import Batches, freeing, text_or_empty
from rainlane.staging import stage

LEAF = 16  # cells on a side of a leaf
BITS = 2  # a square is cut into 4 x 4 ones
ADDED, SCALE = 5, 1_000_000_000
SLICE = 4 << 20
TEXTS_AT_ONCE = 64
MOST_ENTRIES = 300_000
ROWS_AT_ONCE = 20_000
LEAVES_AT_ONCE = 128
MOST_PAIRS = 2000
TERMS_A_BUCKET = 4096


def _plain(byte: int) -> int:
    """A-Z in lower case; what is no letter, but for bytes beyond ASCII, is a blank."""
    if chr(byte).isascii() and not chr(byte).isalpha():
        return 0x20
    return ord(chr(byte).lower()) if byte < 0x80 else byte


PLAIN = bytes(map(_plain, range(256)))


def terms_of(content: bytes):
    """Lists of terms, runs of ASCII letters and of anything beyond ASCII, of a text in UTF-8;
    of a long text a slice at a time."""
    content = content.translate(PLAIN)
    at = 0
    while at < len(content):
        end = content.find(b" ", at + SLICE) if len(content) - at > SLICE else -1
        end = len(content) if end < 0 else end
        yield content[at:end].split()
        at = end


# Counts.


def group_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """Columns lang, source, term, n (occurrences) and docs (documents that have it), and a row
    with the empty term for each group. Tasks add up their own documents first."""

    @freeing
    def counted(batches: Batches) -> Batches:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        entries = 0

        def flush() -> Batches:
            for (lang, source), (counts, documents) in groups.items():
                terms = list(counts)
                for at in range(0, len(terms), ROWS_AT_ONCE):
                    yield rows(lang, source, own := terms[at : at + ROWS_AT_ONCE], [counts[t] for t in own], [documents[t] for t in own])
                yield rows(lang, source, [b""], [0], [0])
            groups.clear()

        def rows(lang: str, source: str, terms: list, counts: list, documents: list) -> pa.RecordBatch:
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(documents, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = part.column(2).cast(pa.binary()).to_pylist()
                for lang, source, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    counts, documents = groups.setdefault((lang, source), (Counter(), Counter()))
                    before, seen = len(counts), set()
                    for terms in terms_of(content):
                        counts.update(terms)
                        seen.update(terms)
                    documents.update(seen)
                    entries += 2 * (len(counts) - before)
                if entries > MOST_ENTRIES:
                    yield from flush()
                    entries = 0
        yield from flush()

    given = docs.select(text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source"), text_or_empty(text).alias("text"))
    parts = given.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def with_price(rows: DataFrame, count: Column, total: Column, name: str) -> DataFrame:
    """``rows`` with the price of ``count`` where all counts are ``total``. The division goes
    on for three digits at a time, so that nothing passes 64 bits for totals below 9 * 10^15."""
    rows = rows.withColumns({"_of": total, "_rest": count + ADDED}).withColumn(name, F.expr("_rest div _of"))
    rows = rows.withColumn("_rest", F.expr("_rest % _of"))
    for _ in range(3):
        rows = rows.withColumn(name, F.expr(f"`{name}` * 1000 + (_rest * 1000) div _of"))
        rows = rows.withColumn("_rest", F.expr("(_rest * 1000) % _of"))
    return rows.withColumn(name, F.col(name) + 1).drop("_of", "_rest")


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """Columns lang, term, lang_n and c: the terms that at least ``least_docs`` documents of a
    language have, with numbers 0, 1, ... without gaps in each language."""
    kept = stage(
        counts.where("term <> ''").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs),
        "kept-terms",
    )
    buckets = max(1, kept.count() // TERMS_A_BUCKET)
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("lang", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    at = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term")) - 1
    numbered = kept.withColumn("at", at).join(sizes, ["lang", "bucket"])
    return numbered.select("lang", "term", "lang_n", (F.col("first") + F.col("at")).alias("c"))


class TermMatrix:
    """Groups, kept terms and the nonzero cells of the matrices of all languages.

    groups: lang, source, r, groups (how many the language has), terms (how many it keeps), n,
    zero (the price of a count of 0). cells: lang, source, r, c, term, price, and lang_price,
    that of the term in the whole language.
    """

    def __init__(self, docs: DataFrame, least_docs: int, text: str = "text", lang: str = "lang", source: str = "source"):
        counts = stage(group_counts(docs, text, lang, source), "group-terms")
        kept = stage(kept_terms(counts, least_docs), "kept-terms")
        cells = counts.join(kept, ["lang", "term"])
        totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
        by_name = Window.partitionBy("lang").orderBy("source")
        groups = counts.where("term = ''").select(
            "lang",
            "source",
            (F.row_number().over(by_name) - 1).cast("long").alias("r"),
            F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("groups"),
        )
        groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        none = F.lit(0).cast("long")
        groups = groups.withColumns({name: F.coalesce(name, none) for name in ("n", "terms", "lang_total")})
        total = F.col("n") + ADDED * F.col("terms")
        # Without kept terms there is nothing to price.
        groups = with_price(groups, none, F.greatest(total, F.lit(1)), "zero")
        self.groups = stage(groups, "groups")
        cells = cells.drop("docs").join(self.groups.withColumnRenamed("n", "total"), ["lang", "source"])
        cells = with_price(cells, F.col("n"), F.col("total") + ADDED * F.col("terms"), "price")
        cells = with_price(cells, F.col("lang_n"), F.col("lang_total") + ADDED * F.col("terms"), "lang_price")
        self.cells = stage(cells.select("lang", "source", "r", "c", "term", "price", "lang_price"), "cells")


# The tree.


def leaves_of(cells: DataFrame) -> DataFrame:
    """Columns lang, i, j and cells (at most LEAF * LEAF of place and price) of each leaf."""
    place = (F.col("r") % LEAF) * LEAF + F.col("c") % LEAF
    return cells.groupBy("lang", F.floor(F.col("r") / LEAF).alias("i"), F.floor(F.col("c") / LEAF).alias("j")).agg(
        F.collect_list(F.struct(place.cast("int").alias("place"), "price")).alias("cells")
    )


def squares_of(leaves: DataFrame, levels: int) -> DataFrame:
    """Columns lang, level, i and j of the squares with a count, leaves being level 0."""
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    each = leaves.select("lang", "i", "j", level)

    def up(name: str) -> Column:
        return F.call_function("shiftright", F.col(name), F.col("level") * BITS).alias(name)

    return each.select("lang", "level", up("i"), up("j")).distinct()


def common_leaves(squares: DataFrame, langs: DataFrame, levels: int) -> DataFrame:
    """The places that the joint traversal ends at: lang, terms, a, b and j, so that the
    leaf (a, j) or (b, j) has a count, a <= b.

    ``langs``: lang, blocks (rows of leaves), stripes (columns of leaves), terms.
    """
    front = langs.select("*", *[F.lit(0).cast("long").alias(name) for name in "abj"])
    for level in range(levels - 1, -1, -1):
        def children(name: str, most: str) -> Column:
            last = F.call_function("shiftright", F.col(most) - 1, F.lit(BITS * level))
            first = F.col(name) * (1 << BITS)
            return F.explode(F.sequence(first, F.least(first + (1 << BITS) - 1, last)))

        parts = front.withColumn("a", children("a", "blocks")).withColumn("b", children("b", "blocks"))
        parts = parts.where("a <= b").withColumn("j", children("j", "stripes"))
        here = squares.where(F.col("level") == level)
        one = here.select("lang", F.col("i").alias("a"), "j", F.lit(True).alias("in_a"))
        two = here.select("lang", F.col("i").alias("b"), "j", F.lit(True).alias("in_b"))
        met = parts.join(one, ["lang", "a", "j"], "left").join(two, ["lang", "b", "j"], "left")
        # What neither has is all zeros, and is gone from the traversal.
        front = stage(met.where("in_a or in_b").select(*langs.columns, "a", "b", "j"), "quadtree")
    return front


def compared(met: DataFrame) -> DataFrame:
    """Columns lang, g, h (rows of the matrix, g < h), apart (sum of the differences of prices
    in the leaves met) and seen (terms in them).

    ``met``: lang, terms, a, b, j, zeros_a, zeros_b (prices of 0 of a block's rows), cells_a
    and cells_b (or null).
    """
    names = ["lang", "g", "h", "apart", "seen"]
    schema = "lang string, g long, h long, apart long, seen long"
    kinds = [pa.string(), *[pa.int64()] * 4]

    def zeros(column: pa.Array) -> np.ndarray:
        """One row of LEAF prices for each row; 0 for rows that there aren't."""
        sizes = np.diff(column.offsets.to_numpy())
        found = np.zeros((len(column), LEAF), np.int64)
        row = np.repeat(np.arange(len(column)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found[row, at] = column.flatten().to_numpy()
        return found

    def dense(column: pa.Array, prices: np.ndarray) -> np.ndarray:
        """The leaves' prices: leaf x row x term."""
        found = np.repeat(prices[:, :, None], LEAF, axis=2)
        sizes = column.value_lengths().fill_null(0).to_numpy()
        flat = column.flatten()
        row = np.repeat(np.arange(len(column)), sizes)
        found.reshape(len(column), -1)[row, flat.field("place").to_numpy()] = flat.field("price").to_numpy()
        return found

    @freeing
    def compare(batches: Batches) -> Batches:
        sums: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            columns: list[list] = [[] for _ in names]
            for (lang, a, b), (apart, seen, rows_a, rows_b) in sums.items():
                g, h = np.meshgrid(np.arange(rows_a) + a * LEAF, np.arange(rows_b) + b * LEAF, indexing="ij")
                pairs = g < h
                n = int(pairs.sum())
                for column, own in zip(columns, ([lang] * n, g[pairs].tolist(), h[pairs].tolist(), apart[:rows_a, :rows_b][pairs].tolist(), [seen] * n)):
                    column += own
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, LEAVES_AT_ONCE):
                part = batch.slice(at, LEAVES_AT_ONCE)
                lang, terms, a, b, j, zeros_a, zeros_b, cells_a, cells_b = part.columns
                width = np.minimum(terms.to_numpy() - j.to_numpy() * LEAF, LEAF)
                there = np.arange(LEAF) < width[:, None]
                one, two = dense(cells_a, zeros(zeros_a)), dense(cells_b, zeros(zeros_b))
                apart = np.abs(one[:, :, None, :] - two[:, None, :, :])
                apart = np.where(there[:, None, None, :], apart, 0).sum(axis=3)
                rows_a, rows_b = zeros_a.value_lengths().to_pylist(), zeros_b.value_lengths().to_pylist()
                keys = zip(lang.to_pylist(), a.to_pylist(), b.to_pylist())
                for k, key in enumerate(keys):
                    own = sums.get(key)
                    if own is None:
                        sums[key] = [apart[k].copy(), int(width[k]), rows_a[k], rows_b[k]]
                    else:
                        own[0] += apart[k]
                        own[1] += int(width[k])
                if len(sums) > MOST_PAIRS:
                    yield flush()
        yield flush()

    return met.mapInArrow(compare, schema).groupBy("lang", "g", "h").agg(
        F.sum("apart").alias("apart"), F.sum("seen").alias("seen")
    )


def source_distances(matrix: TermMatrix) -> DataFrame:
    """Columns lang, source, other and value for each two sources of a language: the sum of the
    differences of their prices over all kept terms. The result has a row for each pair."""
    groups = matrix.groups
    side = "CAST(ceil({} / {}) AS BIGINT)"
    langs = groups.where("terms > 0").select(
        "lang", F.expr(side.format("groups", LEAF)).alias("blocks"), F.expr(side.format("terms", LEAF)).alias("stripes"), "terms"
    ).distinct()
    largest = langs.agg(F.max(F.greatest("blocks", "stripes"))).first()[0] or 1
    levels = max(1, -(-(int(largest) - 1).bit_length() // BITS))
    leaves = stage(leaves_of(matrix.cells), "quadtree-leaves")
    squares = stage(squares_of(leaves, levels), "quadtree-squares")
    ends = common_leaves(squares, langs, levels)
    rows = F.transform(F.sort_array(F.collect_list(F.struct("r", "zero"))), lambda own: own["zero"])
    zeros = stage(groups.groupBy("lang", F.floor(F.col("r") / LEAF).alias("i")).agg(rows.alias("zeros")), "zero-prices")

    def side_of(name: str) -> tuple[DataFrame, DataFrame]:
        return (
            zeros.select("lang", F.col("i").alias(name), F.col("zeros").alias(f"zeros_{name}")),
            leaves.select("lang", F.col("i").alias(name), "j", F.col("cells").alias(f"cells_{name}")),
        )

    (zeros_a, leaves_a), (zeros_b, leaves_b) = side_of("a"), side_of("b")
    met = ends.join(leaves_a, ["lang", "a", "j"], "left").join(leaves_b, ["lang", "b", "j"], "left")
    met = met.join(zeros_a, ["lang", "a"]).join(zeros_b, ["lang", "b"])
    sums = stage(
        compared(met.select("lang", "terms", "a", "b", "j", "zeros_a", "zeros_b", "cells_a", "cells_b")), "source-distances"
    )
    one = groups.select("lang", F.col("r").alias("g"), F.col("source").alias("s"), F.col("zero").alias("zero_s"), "terms")
    two = groups.select("lang", F.col("r").alias("h"), F.col("source").alias("t"), F.col("zero").alias("zero_t"))
    pairs = one.join(two, "lang").where("g < h").join(sums, ["lang", "g", "h"], "left")
    none = F.lit(0).cast("long")
    # The terms not seen lie in squares that are zero for both.
    unseen = (F.col("terms") - F.coalesce("seen", none)) * F.abs(F.col("zero_s") - F.col("zero_t"))
    value = F.coalesce("apart", none) + unseen
    sides = F.array(
        F.struct(F.col("s").alias("source"), F.col("t").alias("other")),
        F.struct(F.col("t").alias("source"), F.col("s").alias("other")),
    )
    return pairs.select("lang", value.alias("value"), F.inline(sides))


def raised_terms(matrix: TermMatrix, most: int) -> DataFrame:
    """Columns lang, source, term, value and rank: of each group the ``most`` terms that it has
    and that cost more in it than in the language, by the difference."""
    value = (F.col("price") - F.col("lang_price")).alias("value")
    raised = matrix.cells.where("price > lang_price").select("lang", "source", "term", value)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return raised.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def audit(docs: DataFrame, least_docs: int = 30, most_terms: int = 50, **columns) -> DataFrame:
    """Columns lang, source, part, item, value and rank: part ``pair`` has each other source of
    the language by distance, part ``term`` the terms that are most raised."""
    matrix = TermMatrix(docs, least_docs, **columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = source_distances(matrix).withColumn("rank", F.row_number().over(order))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank")
    terms = raised_terms(matrix, most_terms).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
    return pairs.unionByName(terms)
