"""Reply trees to formatted conversations.

Messages reply to messages. Iterative self-joins double the distance that each message's
pointer to an ancestor spans; that gives depth, score and length of the way from the root to
each message, and the same pointers, taken from far to near, list the messages of each
chosen root-to-leaf path. Leaves of a tree are ranked by the mean score of their path. Each
chosen path is formatted as one conversation, and can be read back.

The joins move identifiers and numbers only; a text is moved to its place in the table of
contents and from there to its path.

The template is ``<|im_start|>role`` newline ``text<|im_end|>`` newline for each turn. In
texts and roles a ``<`` and a ``|`` with any number of backslashes between them get one more,
so that no ``<|`` but the template's occurs; in roles backslashes and newlines are written
as two characters before. Both are undone on reading.

A formatted conversation comes in parts of about ``PART`` code points, cut between turns, so
that one of any length fits into rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainlane.llm.common import Batches, freeing, place_in_files, text_or_empty
from rainlane.llm.prefix_trie import digested, placed
from rainlane.staging import stage

START, END = "<|im_start|>", "<|im_end|>\n"
PART = 4_000_000
SUMS = ["depth", "score", "chars"]


# The template.


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda own: "\n" if own[1] == "n" else own[1], unescaped(role))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END))


def contents_of(messages: DataFrame) -> DataFrame:
    """Columns content (what tells messages apart), role and text, null ones empty."""
    return messages.select("content", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))


def measures(loss_role: str) -> dict[str, Column]:
    """Of a message its chars (code points of the formatted turn) and loss_from (where in it the
    text begins, if the role is the one whose texts are learned)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    begin = F.lit(len(START) + 1) + F.char_length(escaped_role(role))
    return {
        "chars": F.char_length(formatted_turn(role, text)).cast("long"),
        "loss_from": F.when(role == loss_role, begin.cast("long")),
    }


# Paths.


def chosen_paths(links: DataFrame, keep: int | None = 1) -> DataFrame:
    """Columns tree, leaf, last (code points of the path before its last turn), and of each
    message of the path content, depth (1 is the root), start (code points before it), chars
    and loss_from.

    ``links``: tree, message, parent, score, content, chars, loss_from. Of rows with the same
    tree and message one counts. A message whose parent is null or not in the tree is a root.
    Messages in a cycle, and replies to them, are on no path. A null score counts as 0. Of
    each tree the ``keep`` leaves with the highest mean score are chosen (ties: the longer
    path, then the smaller message); None: all.
    """
    rest = ["parent", "score", "content", "chars", "loss_from"]
    one = links.where("tree is not null and message is not null").groupBy("tree", "message").agg(
        F.min(F.struct(*rest)).alias("own")
    )
    one = stage(one.select("tree", "message", "own.*"), "replies")
    there = one.select("tree", F.col("message").alias("parent"), F.lit(True).alias("there"))
    begun = one.where("parent is not null").join(there, ["tree", "parent"])
    begun = begun.unionByName(one.join(begun.select("tree", "message"), ["tree", "message"], "left_anti").withColumns(
        {"parent": F.lit(None).cast(one.schema["parent"].dataType), "there": F.lit(True)}
    ))
    now = begun.select(
        "tree",
        "message",
        F.col("parent").alias("up"),
        F.lit(1).cast("long").alias("depth"),
        F.coalesce("score", F.lit(0)).cast("double").alias("score"),
        "chars",
    )
    now = stage(now, "replies-up")
    first, jumps = now, []
    largest = now.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(largest).bit_length()):
        if now.where("up is not null").isEmpty():
            break
        jumps.append(now.where("up is not null").select("tree", "message", "up"))
        above = now.select(
            "tree", F.col("message").alias("up"), F.col("up").alias("further"), *[F.col(s).alias(f"more_{s}") for s in SUMS]
        )
        moved = now.where("up is not null").join(above, ["tree", "up"]).select(
            "tree", "message", F.col("further").alias("up"), *[(F.col(s) + F.col(f"more_{s}")).alias(s) for s in SUMS]
        )
        now = stage(moved.unionByName(now.where("up is null")), "replies-up")
    whole = now.where("up is null").drop("up")
    parents = first.where("up is not null").select("tree", F.col("up").alias("message"))
    leaves = whole.join(parents, ["tree", "message"], "left_anti")
    if keep is not None:
        order = [F.desc(F.col("score") / F.col("depth")), F.desc("depth"), F.asc("message")]
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(*order))
        leaves = leaves.withColumn("rank", rank).where(F.col("rank") <= keep)
    paths = stage(leaves.select("tree", F.col("message").alias("leaf"), "message"), "reply-paths")
    for jump in reversed(jumps):
        higher = paths.join(jump, ["tree", "message"]).select("tree", "leaf", F.col("up").alias("message"))
        paths = stage(paths.unionByName(higher), "reply-paths")
    ends = whole.select("tree", F.col("message").alias("leaf"), F.col("chars").alias("whole"))
    own = one.select("tree", "message", "content", F.col("chars").alias("own_chars"), "loss_from")
    return (
        paths.join(whole.select("tree", "message", "depth", "chars").join(own, ["tree", "message"]), ["tree", "message"])
        .join(ends, ["tree", "leaf"])
        .select(
            "tree",
            "leaf",
            "whole",
            "content",
            "depth",
            (F.col("chars") - F.col("own_chars")).alias("start"),
            F.col("own_chars").alias("chars"),
            "loss_from",
        )
    )


# Formatting and reading.


def formatted(paths: DataFrame, contents: DataFrame, part_chars: int = PART) -> DataFrame:
    """Columns tree, leaf, whole (code points of the conversation), part, begin (code points
    before the part), text, and loss: from where to where in the conversation loss is taken."""
    turns = paths.join(contents, "content").select(
        "tree",
        "leaf",
        "whole",
        F.floor(F.col("start") / part_chars).alias("part"),
        "depth",
        "start",
        formatted_turn(F.col("role"), F.col("text")).alias("turn"),
        F.when(
            F.col("loss_from").isNotNull(),
            F.struct(
                (F.col("start") + F.col("loss_from")).alias("begin"),
                (F.col("start") + F.col("chars") - len(END)).alias("end"),
            ),
        ).alias("loss"),
    )
    parts = turns.groupBy("tree", "leaf", "part").agg(
        F.any_value("whole").alias("whole"),
        F.min("start").alias("begin"),
        F.sort_array(F.collect_list(F.struct("depth", "turn"))).alias("turns"),
        F.sort_array(F.collect_list("loss")).alias("loss"),
    )
    return parts.select("tree", "leaf", "whole", "part", "begin", F.array_join("turns.turn", "").alias("text"), "loss")


class _Reader:
    """What was read of one conversation so far."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def take(self, text: str, begin: int, loss: list) -> None:
        *turns, rest = text.split(END)
        if rest or begin != self.chars:
            raise ValueError("a part that does not follow the one before, or ends within a turn")
        for turn in turns:
            if not turn.startswith(START):
                raise ValueError("a turn without its mark")
            role, _, own = turn[len(START) :].partition("\n")
            self.turns.update(f"{unescaped_role(role)}\n{unescaped(own)}\n".encode())
        for span in loss:
            own = unescaped(text[span["begin"] - begin : span["end"] - begin])
            self.loss.update(own.encode())
            self.loss_chars += len(own)
        self.n_turns += len(turns)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = "tree long, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted conversations say: tree, leaf, n_turns, turns_sha256 (role, newline, text,
    newline of each turn), loss_chars and loss_sha256 (the texts under the mask) and
    formatted_chars. A conversation in several parts is read part by part."""
    names = [column.split()[0] for column in READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    @freeing
    def read(batches: Batches) -> Batches:
        key, reader = None, None
        for batch in batches:
            done = []
            for tree, leaf, begin, text, loss in zip(*batch.columns):
                own = tree.as_py(), leaf.as_py()
                if own != key:
                    if key is not None:
                        done.append((*key, *reader.row()))
                    key, reader = own, _Reader()
                reader.take(text.as_py(), begin.as_py(), loss.as_py())
            yield rows(done)
        yield rows([(*key, *reader.row())] if key is not None else [])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    # A conversation that is one part is read where it lies.
    in_one = (F.col("begin") == 0) & (F.col("whole") == F.char_length("text"))
    several = parts.where(~in_one).repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "part")
    given = ["tree", "leaf", "begin", "text", "loss"]
    return parts.where(in_one).select(*given).mapInArrow(read, READ).unionByName(several.select(*given).mapInArrow(read, READ))


# Tables of conversations.


def with_content_key(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of a table read from files, and each row's place in them."""
    file, row = place_in_files(conversations)
    key = F.struct(F.xxhash64(file).alias("file"), row.cast("long").alias("row"))
    return conversations.select("conv_id", "turn", "role", "text", key.alias("content"))


def replies_in_turn(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Links of messages with conv_id, turn, role, text and content in which each turn replies
    to the one before, by turn (null first; ties: by a hash of the content). Rows without a
    conversation identifier belong to no conversation."""
    sizes = measures(loss_role)
    turns = placed(digested(messages.withColumns(sizes), "content", *sizes))
    return turns.select(
        F.col("conv").alias("tree"),
        F.col("place").cast("long").alias("message"),
        F.when(F.col("place") > 1, F.col("place") - 1).cast("long").alias("parent"),
        F.lit(0.0).alias("score"),
        "content",
        *sizes,
    )
