"""Z-fast trie of conversations: what they share from their first turn on.

A prefix is known by its depth and 128 bits: the exclusive or of a hash of each turn with
its place. The trie is compacted: a node stands for the edge that ends in it, from below its
parent's depth (``lo``) down to its own (``x``), and is found in a table by its handle, the
prefix at the two-fattest depth of that edge, which is the depth in (lo, x] that the largest
power of two divides. A conversation's exit node is located by fat binary search, one look-up
of a handle for each halving of its depth. A batch of conversations is inserted at once:
only what lies beyond their exits becomes rows; edges they leave in the middle are split.

Sums over subtrees are taken by pointer doubling over the compacted nodes, so the number of
rounds follows from the logarithm of the height. At the end the edges are expanded to one row per depth.

Rows without a conversation identifier belong to no conversation. Null role or text counts
as empty; turns of a conversation with the same number are in order of a hash of their
content; repeated rows are turns of their own. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainlane.llm.common import Batches, freeing, text_or_empty
from rainlane.staging import stage

CHAIN = "d long, p long, q long, pp long, pq long, cum long, points long, rep long, x long"
NODES = (
    "rep long, x long, xp long, xq long, lo long, lp long, lq long, fp long, fq long, "
    "hd long, hp long, hq long, cum_x long, cum_lo long"
)
NO_MEMBER = hashlib.sha256(b"").hexdigest()
PIECE_BYTES = 1 << 20


# Turns to prefixes.


def digested(turns: DataFrame, *more: str) -> DataFrame:
    """Columns conv, turn, a, b (120 bits of the SHA-256 of role and text) and points (code
    points of the text), from conv_id, turn, role and text, and the columns ``more``."""
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")

    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        part(1).alias("a"),
        part(16).alias("b"),
        F.char_length(text).cast("long").alias("points"),
        *more,
    )


def _over_parts(rows: DataFrame, order: list, running: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """``running`` over each conversation in ``order``, added to what the conversation has in
    earlier parts by ``carried`` (the same aggregates, and exclusive or for xor_ names).

    A conversation may lie in several parts (column part), each of which a task of its own works on.
    At most two conversations of a part go on in another, so what is carried is twice as many rows
    as there are parts.
    """
    own = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumns({name: value.over(own) for name, value in running.items()})
    totals = rows.groupBy("conv", "part").agg(*[value.alias(name) for name, value in carried.items()])
    several = Window.partitionBy("conv")
    before = several.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("parts", F.count(F.lit(1)).over(several))
    so_far = {name: (F.bit_xor(name) if name.startswith("xor_") else F.sum(name)).over(before) for name in carried}
    earlier = (
        totals.where("parts > 1")
        .select("conv", "part", *[F.coalesce(value, F.lit(0)).alias(f"_{name}") for name, value in so_far.items()])
    )
    found = found.join(F.broadcast(earlier), ["conv", "part"], "left")

    def whole(name: str) -> Column:
        carry = F.coalesce(F.col(f"_{name}"), F.lit(0))
        return F.col(name).bitwiseXOR(carry) if name.startswith("xor_") else F.col(name) + carry

    return found.withColumns({name: whole(name) for name in running}).drop(*[f"_{name}" for name in carried])


def placed(turns: DataFrame) -> DataFrame:
    """``digested`` turns with their place (1, 2, ...) in their conversation, by turn (null
    first), and the part of a range of all turns that they lie in."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    ranges = stage(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "trie-turns")
    return _over_parts(ranges, order[1:], {"place": F.row_number()}, {"place": F.count(F.lit(1))})


def prefixes(rows: DataFrame) -> DataFrame:
    """Of turns with conv, place, part, a, b, points the prefix that ends in each: p, q, those
    of the prefix before (pp, pq), and cum, the code points so far."""
    keyed = rows.select(
        "conv",
        "place",
        "part",
        "points",
        F.xxhash64(F.lit(1), "place", "a", "b").alias("g"),
        F.xxhash64(F.lit(2), "place", "a", "b").alias("h"),
    )
    sums = {"xor_p": F.bit_xor("g"), "xor_q": F.bit_xor("h"), "cum": F.sum("points")}
    found = _over_parts(keyed, ["place"], sums, sums)
    return found.select(
        "conv",
        "place",
        F.col("xor_p").alias("p"),
        F.col("xor_q").alias("q"),
        F.col("xor_p").bitwiseXOR(F.col("g")).alias("pp"),
        F.col("xor_q").bitwiseXOR(F.col("h")).alias("pq"),
        "cum",
        "points",
    )


# The trie.


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    length = F.length(F.bin(low.bitwiseXOR(high)))
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), length - 1))


class PrefixTrie:
    """A trie that takes conversations in by batches.

    ``most_turns``: a conversation is searched for by an array of its prefixes up to so many
    turns, and by look-ups in a table of them beyond. ``broadcast_nodes``: the nodes are
    broadcast to a search up to so many, and shuffled beyond.
    """

    def __init__(self, spark: SparkSession, most_turns: int = 4096, broadcast_nodes: int = 100_000):
        self.spark, self.most_turns, self.broadcast_nodes = spark, most_turns, broadcast_nodes
        self.chain = spark.createDataFrame([], CHAIN)
        self.nodes = spark.createDataFrame([], NODES)
        self.n_nodes = 0
        self.members: list[DataFrame] = []

    def insert(self, members: DataFrame, rows: DataFrame) -> None:
        """Take in conversations: ``members`` (conv) names all, also those without turns, and
        ``rows`` has their ``prefixes``."""
        sizes = rows.groupBy("conv").agg(F.max("place").alias("depth"))
        longs = sizes.where(F.col("depth") > self.most_turns)
        long_rows = None
        if not longs.isEmpty():
            longs = stage(longs, "trie-longs")
            long_rows = stage(rows.join(longs, "conv"), "trie-long-rows")
            rows = rows.join(longs, "conv", "left_anti")
        path = F.sort_array(F.collect_list(F.struct("place", "p", "q", "cum")))
        paths = rows.groupBy("conv").agg(path.alias("path")).withColumn("depth", F.size("path").cast("long"))
        last = F.get("path", F.col("depth").cast("int") - 1)
        paths = paths.select("conv", "depth", "path", last["p"].alias("ep"), last["q"].alias("eq"))
        if long_rows is not None:
            ends = long_rows.where("place = depth").select(
                "conv", "depth", F.lit(None).cast(paths.schema["path"].dataType).alias("path"), F.col("p").alias("ep"), F.col("q").alias("eq")
            )
            paths = paths.unionByName(ends)
        none = F.lit(0).cast("long")
        state = members.distinct().join(paths, "conv", "left").select(
            "conv", "path", *[F.coalesce(name, none).alias(name) for name in ("depth", "ep", "eq")]
        )
        state = stage(state, "trie-batch")
        self.members.append(state.select("conv", "depth", "ep", "eq"))
        found = stage(self._located(state, long_rows), "trie-exits")
        self._grow(found, long_rows)

    def _at(self, state: DataFrame, depth: Column, name: str, long_rows: DataFrame | None) -> DataFrame:
        """``state`` with the prefix of each conversation at ``depth`` (null where there is
        none) in the columns name_p and name_q."""
        entry = F.get("path", (depth - 1).cast("int"))
        if long_rows is None:
            return state.withColumns({f"{name}_p": entry["p"], f"{name}_q": entry["q"]})
        asked = state.withColumn("_at", depth)
        there = long_rows.select(
            F.col("conv").alias("_conv"), F.col("place").alias("_place"), F.col("p").alias("_p"), F.col("q").alias("_q")
        )
        met = asked.join(there, (F.col("conv") == F.col("_conv")) & (F.col("_at") == F.col("_place")), "left")
        both = {f"{name}_{k}": F.coalesce(entry[k], F.col(f"_{k}")) for k in "pq"}
        return met.withColumns(both).drop("_at", "_conv", "_place", "_p", "_q")

    def _located(self, state: DataFrame, long_rows: DataFrame | None) -> DataFrame:
        """``state`` with lo, the depth of the deepest node on the conversation's way, and the
        edge (edge_rep, edge_x) that it leaves in the middle, if it does."""
        found = state.withColumns({"lo": F.lit(0).cast("long"), "hi": F.col("depth")})
        none = F.lit(None).cast("long")
        if not self.n_nodes:
            return found.drop("hi").withColumns({"edge_rep": none, "edge_x": none})
        deepest = state.agg(F.max("depth")).first()[0] or 0
        nodes = F.broadcast(self.nodes) if self.n_nodes <= self.broadcast_nodes else self.nodes
        handles = nodes.select("hd", "hp", "hq", "x", "xp", "xq", F.col("lo").alias("top"))
        for _ in range(int(deepest).bit_length()):
            open_ = F.col("lo") < F.col("hi")
            probe = found.withColumn("f", F.when(open_, two_fattest(F.col("lo"), F.col("hi"))))
            probe = self._at(probe, F.col("f"), "f", long_rows)
            met = probe.join(handles, (F.col("f") == F.col("hd")) & (F.col("f_p") == F.col("hp")) & (F.col("f_q") == F.col("hq")), "left")
            met = self._at(met, F.col("x"), "x", long_rows)
            hit = F.col("hd").isNotNull()
            through = hit & F.coalesce((F.col("x_p") == F.col("xp")) & (F.col("x_q") == F.col("xq")), F.lit(False))
            found = met.select(
                *state.columns,
                F.when(through, F.col("x")).when(hit, F.col("top")).otherwise(F.col("lo")).alias("lo"),
                F.when(through | ~open_, F.col("hi")).when(hit, F.col("top")).otherwise(F.col("f") - 1).alias("hi"),
            )
        found = self._at(found.drop("hi"), F.col("lo") + 1, "n", long_rows)
        firsts = nodes.select(
            F.col("lo").alias("top"), "fp", "fq", F.col("rep").alias("edge_rep"), F.col("x").alias("edge_x")
        )
        on_edge = (F.col("lo") == F.col("top")) & (F.col("n_p") == F.col("fp")) & (F.col("n_q") == F.col("fq"))
        return found.join(firsts, on_edge, "left").select(*state.columns, "lo", "edge_rep", "edge_x")

    def _grow(self, found: DataFrame, long_rows: DataFrame | None) -> None:
        """Put what lies beyond the exits into the trie."""
        zero = F.lit(0).cast("long")

        def row(k: Column) -> Column:
            entry, before = F.get("path", k), F.get("path", k - 1)
            return F.struct(
                (k + 1).cast("long").alias("d"),
                entry["p"].alias("p"),
                entry["q"].alias("q"),
                F.coalesce(before["p"], zero).alias("pp"),
                F.coalesce(before["q"], zero).alias("pq"),
                entry["cum"].alias("cum"),
                (entry["cum"] - F.coalesce(before["cum"], zero)).alias("points"),
            )

        places = F.sequence(F.col("lo").cast("int"), F.col("depth").cast("int") - 1)
        new = found.where("depth > lo and path is not null").select("conv", "depth", F.inline(F.transform(places, row)))
        if long_rows is not None:
            more = long_rows.join(found.where("path is null").select("conv", "lo"), "conv").where("place > lo")
            new = new.unionByName(
                more.select("conv", "depth", F.col("place").alias("d"), "p", "q", "pp", "pq", "cum", "points")
            )
        touched = found.where("edge_rep is not null").select(F.col("edge_rep").alias("rep"), F.col("edge_x").alias("x")).distinct()
        old_chain = None
        if self.n_nodes:
            touched = stage(touched, "trie-touched")
            old_chain = self.chain.join(touched, ["rep", "x"], "left_anti")
            split = self.chain.join(touched, ["rep", "x"], "left_semi")
            # As rows of the edge's own conversation that end where its node is.
            new = new.unionByName(
                split.select(F.col("rep").alias("conv"), F.col("x").alias("depth"), "d", "p", "q", "pp", "pq", "cum", "points")
            )
        same = {name: F.any_value(name).alias(name) for name in ("pp", "pq", "cum", "points")}
        rows = new.groupBy("d", "p", "q").agg(
            *same.values(), F.min("conv").alias("rep"), F.max(F.col("d") == F.col("depth")).alias("ends")
        )
        rows = stage(rows, "trie-rows")
        below = rows.groupBy((F.col("d") - 1).alias("d"), F.col("pp").alias("p"), F.col("pq").alias("q")).agg(
            F.count(F.lit(1)).alias("kids")
        )
        stays = F.col("ends") | (F.coalesce("kids", F.lit(0)) != 1)
        # The rows of one edge have the same representative, and their prefixes lie on its way.
        downwards = Window.partitionBy("rep").orderBy(F.desc("d"))
        grown = (
            rows.join(below, ["d", "p", "q"], "left")
            .withColumn("x", F.min(F.when(stays, F.col("d"))).over(downwards))
            .select(*[c.split()[0] for c in CHAIN.split(", ")])
        )
        grown = stage(grown, "trie-grown")
        nodes = _nodes_of(grown)
        if old_chain is not None:
            grown = stage(old_chain.unionByName(grown), "trie-chain")
            nodes = self.nodes.join(touched, ["rep", "x"], "left_anti").unionByName(nodes)
        self.chain, self.nodes = grown, stage(nodes, "trie-nodes")
        self.n_nodes = self.nodes.count()

    # Results.

    def expanded(self) -> DataFrame:
        """One row per prefix that some conversation starts with, the empty one (depth 0)
        included: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
        n_leaves, saved_tokens (code points that members have in common with another, each
        node's (n_convs - 1) times those of its last turn, over its subtree) and ends_sha256
        (of the identifiers of the members that end there)."""
        if not self.members:
            return self.spark.createDataFrame([], "conv_id long").select(*_result_columns(F.lit(None), None))
        members = reduce(DataFrame.unionByName, self.members)
        ends = members.groupBy(F.col("ep").alias("xp"), F.col("eq").alias("xq")).agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")
        )
        kids = self.nodes.groupBy(F.col("lp").alias("xp"), F.col("lq").alias("xq")).agg(F.count(F.lit(1)).alias("kids"))
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
        root = self.spark.range(1).select(
            zero.alias("xp"), zero.alias("xq"), zero.alias("x"), none.alias("lp"), none.alias("lq"), zero.alias("cum_x"), zero.alias("cum_lo")
        )
        own = self.nodes.select(*root.columns).unionByName(root)
        own = own.join(ends, ["xp", "xq"], "left").join(kids, ["xp", "xq"], "left").withColumn("kids", F.coalesce("kids", zero))
        own = own.withColumn("n", F.coalesce("n", zero))
        own = own.select(
            "xp",
            "xq",
            "kids",
            F.col("lp").alias("ap"),
            F.col("lq").alias("aq"),
            "n",
            "least",
            (F.col("kids") == 0).cast("long").alias("leaves"),
            (F.col("n") * F.col("cum_x")).alias("total"),
            (F.col("cum_x") - F.col("cum_lo")).alias("once"),
        )
        values = _subtree_sums(stage(own, "trie-values")).drop("ap", "aq")
        digests = joined_digests(members.select(F.col("ep").alias("xp"), F.col("eq").alias("xq"), "conv"))
        values = stage(values.join(digests, ["xp", "xq"], "left"), "trie-sums")
        top = values.where("xp = 0 and xq = 0").first()
        if top is None or top.least is None:
            return self.spark.createDataFrame([], "conv_id long").select(*_result_columns(F.lit(None), None))
        parents = values.select(F.col("xp").alias("lp"), F.col("xq").alias("lq"), F.col("least").alias("parent_least"))
        at_root = (F.col("lp") == 0) & (F.col("lq") == 0)
        edges = self.nodes.select("rep", "x", "xp", "xq", "lo", "lp", "lq", "cum_lo")
        edges = (
            edges.where(~at_root).join(parents, ["lp", "lq"])
            .unionByName(edges.where(at_root).withColumn("parent_least", F.lit(top.least).cast("long")))
        )
        edges = edges.drop("lp", "lq").join(values, ["xp", "xq"])
        before = F.col("cum") - F.col("points")
        saved = (F.col("total") - F.col("n") * before) - (F.col("once") - (before - F.col("cum_lo")))
        ends_here = F.when(F.col("depth") == F.col("x"), F.col("ends_sha256"))
        rows = self.chain.select("rep", "x", F.col("d").alias("depth"), "cum", "points").join(edges, ["rep", "x"]).select(
            F.col("least").alias("conv_id"),
            "depth",
            F.when(F.col("depth") == F.col("lo") + 1, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(F.col("depth") < F.col("x"), F.lit(1).cast("long")).otherwise(F.col("kids")).alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            saved.alias("saved_tokens"),
            F.coalesce(ends_here, F.lit(NO_MEMBER)).alias("ends_sha256"),
        )
        root_row = values.where("xp = 0 and xq = 0").select(
            F.col("least").alias("conv_id"),
            zero.alias("depth"),
            none.alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("kids").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("total") - F.col("once")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_MEMBER)).alias("ends_sha256"),
        )
        return rows.unionByName(root_row)


def _result_columns(value: Column, digest: str | None) -> list[Column]:
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
    return [*[value.cast("long").alias(name) for name in names], F.lit(digest).cast("string").alias("ends_sha256")]


def _nodes_of(chain: DataFrame) -> DataFrame:
    """The nodes that edges given by their rows end in."""
    fattest = F.col("d").bitwiseAND(-F.col("d"))
    found = chain.groupBy("rep", "x").agg(
        (F.min("d") - 1).alias("lo"),
        F.max_by(F.struct("p", "q", "cum"), "d").alias("end"),
        F.min_by(F.struct("p", "q", "pp", "pq"), "d").alias("first"),
        F.max_by(F.struct("d", "p", "q"), fattest).alias("handle"),
        F.sum("points").alias("points"),
    )
    return found.select(
        "rep",
        "x",
        F.col("end.p").alias("xp"),
        F.col("end.q").alias("xq"),
        "lo",
        F.col("first.pp").alias("lp"),
        F.col("first.pq").alias("lq"),
        F.col("first.p").alias("fp"),
        F.col("first.q").alias("fq"),
        F.col("handle.d").alias("hd"),
        F.col("handle.p").alias("hp"),
        F.col("handle.q").alias("hq"),
        F.col("end.cum").alias("cum_x"),
        (F.col("end.cum") - F.col("points")).alias("cum_lo"),
    )


def _subtree_sums(values: DataFrame) -> DataFrame:
    """n, leaves, total and once added up, and the smallest of least, over the subtree of each
    node (xp, xq), whose parent is (ap, aq), null for the root.

    After k rounds a node has the sums over what is less than 2^k nodes below it, and points
    to its ancestor at that distance.
    """
    adds = ["n", "leaves", "total", "once"]
    at_root = (F.col("ap") == 0) & (F.col("aq") == 0)
    while not values.where("ap is not null").isEmpty():
        given = values.where("ap is not null").groupBy(F.col("ap").alias("xp"), F.col("aq").alias("xq")).agg(
            *[F.sum(name).alias(f"more_{name}") for name in adds], F.min("least").alias("more_least")
        )
        pointers = values.select(
            F.col("xp").alias("ap"), F.col("xq").alias("aq"), F.col("ap").alias("next_p"), F.col("aq").alias("next_q")
        )
        # Pointers to the root, which may be most, end without a look-up.
        inner = values.where("ap is not null").where(~at_root).join(pointers, ["ap", "aq"])
        none = F.lit(None).cast("long")
        ended = values.where(at_root | F.col("ap").isNull()).withColumns({"next_p": none, "next_q": none})
        moved = inner.unionByName(ended).join(given, ["xp", "xq"], "left")
        values = stage(
            moved.select(
                "xp",
                "xq",
                "kids",
                F.col("next_p").alias("ap"),
                F.col("next_q").alias("aq"),
                F.least("least", "more_least").alias("least"),
                *[(F.col(name) + F.coalesce(f"more_{name}", F.lit(0))).alias(name) for name in adds],
            ),
            "trie-values",
        )
    return values


def joined_digests(members: DataFrame) -> DataFrame:
    """Columns xp, xq and ends_sha256: SHA-256 of each group's conv in ascending order, as
    decimal numbers with commas between.

    Tasks over ranges make pieces of text of at most about a megabyte; a group's pieces then
    pass through one hash one after another, so that a group of any size is never held.
    """

    @freeing
    def pieces(batches: Batches) -> Batches:
        key, first, text, size = None, None, [], 0
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[], [], [], []]
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["xp", "xq", "first", "piece"])

        waiting = 0
        for batch in batches:
            for p, q, conv in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (p, q) != key or size > PIECE_BYTES:
                    if text:
                        done.append((*key, first, ",".join(text).encode()))
                        waiting += size
                    key, first, text, size = (p, q), conv, [], 0
                text.append(str(conv))
                size += len(text[-1]) + 1
            if waiting > 4 * PIECE_BYTES or len(done) > 10_000:
                yield out()
                waiting = 0
        if text:
            done.append((*key, first, ",".join(text).encode()))
        yield out()

    @freeing
    def hashed(batches: Batches) -> Batches:
        key, digest = None, None
        for batch in batches:
            done = []
            for p, q, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (p, q) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (p, q), hashlib.sha256(piece.as_py())
                else:
                    digest.update(b"," + piece.as_py())
            yield _digest_rows(done)
        yield _digest_rows([(*key, digest.hexdigest())] if key is not None else [])

    order = ["xp", "xq", "conv"]
    ranges = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    found = ranges.mapInArrow(pieces, "xp long, xq long, first long, piece binary")
    groups = found.repartition("xp", "xq").sortWithinPartitions("xp", "xq", "first")
    return groups.mapInArrow(hashed, "xp long, xq long, ends_sha256 string")


def _digest_rows(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) if done else [[], [], []]
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["xp", "xq", "ends_sha256"])


def trie_of(
    members: DataFrame, rows: DataFrame, batches: tuple[int, ...] = (1, 3, 12), **options
) -> PrefixTrie:
    """A trie of all conversations, inserted in batches that hold these shares of them, the
    small ones first, so that most are searched for in a trie that has their common turns."""
    trie = PrefixTrie(rows.sparkSession, **options)
    slot = F.pmod(F.xxhash64("conv"), F.lit(sum(batches)))
    begin = 0
    for size in batches:
        own = (slot >= begin) & (slot < begin + size)
        trie.insert(members.where(own), rows.where(own))
        begin += size
    return trie


def prefix_nodes(conversations: DataFrame, **options) -> DataFrame:
    """``PrefixTrie.expanded`` of a table with conv_id, turn, role and text."""
    turns = stage(placed(digested(conversations)), "trie-places")
    rows = stage(prefixes(turns), "trie-prefixes")
    return trie_of(turns.select("conv").distinct(), rows, **options).expanded()


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``placed`` turns of conversations rebuilt so that neighbours share their beginning:
    conversation c gets the first h turns of c - c % every, where h is the CRC-32 of its
    decimal number modulo ``most``, and then its own turns after its first h."""
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("first_part"))
    convs = convs.withColumns({"head": head, "base": F.col("conv") - F.col("conv") % every})
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_turns"))
    convs = stage(convs.join(bases, "base", "left"), "trie-heads")
    shared = F.least("head", F.coalesce("base_turns", F.lit(0)))
    columns = ["conv", "place", "part", "a", "b", "points"]
    heads = turns.where(F.col("place") < most).select(F.col("conv").alias("base"), "place", "a", "b", "points")
    lent = heads.join(convs, "base").where("place <= head").withColumnRenamed("first_part", "part").select(*columns)
    own = turns.join(convs.select("conv", "head", shared.alias("shared")), "conv").where("place > head")
    return lent.unionByName(own.withColumn("place", F.col("place") - F.col("head") + F.col("shared")).select(*columns))
