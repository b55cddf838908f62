"""Sum-of-squares online packing of documents into token windows.

Each task packs the documents of its own partition as they come, without a shuffle.
Whole windows are cut off a document first. What remains goes to the fill level for
which the sum of the squared numbers of partially filled windows per level becomes
least; the numbers are tracked in an array with one entry per level. Windows that are
still open at the end of the partition are joined and cut anew where a window is full,
so at most one window of a partition is padded.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainlane.llm.common import freeing
from rainlane.llm.wordcache import WordCache

ROWS_AT_ONCE, WORDS_AT_ONCE = 256, 500
BLANK_NAME = "Ġ"  # fixed: how byte-level vocabularies write a blank


class CachedTokenizer:
    """Token ids of whole texts by a byte-level BPE file, encoded once per distinct word.

    Such a vocabulary never joins what stands before a single blank with what stands
    after it, so a text is cut before each blank and the parts are encoded alone. Texts
    with two blanks in a row are encoded whole. Strings of special tokens count as
    ordinary text.
    """

    def __init__(self, path: str):
        # A worker is one of as many as there are cores; threads of its own only take memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = (self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size()))
        self.opens = np.array([name.startswith(BLANK_NAME) for name in names])
        self.words = WordCache(self._encode_words, most_words=250_000)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int64) for x in found]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words: many in one call, told apart by the ids that begin with a blank.

        A word that opens a text is kept with a blank before it. It is encoded alone, and
        so is an empty one, which is a blank.
        """
        lines: list[str] = []
        together: list[bool] = []
        run: list[str] = []
        for word in [*words, " "]:
            alone = not word or word[0] == " "
            if run and (alone or len(run) == WORDS_AT_ONCE):
                lines.append(" " + " ".join(run))
                together.append(True)
                run = []
            if alone:
                lines.append(word[1:] if word else " ")
                together.append(False)
            else:
                run.append(word)
        found = self._encode(lines[:-1])
        counts = [
            np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids))) if many else [len(ids)]
            for ids, many in zip(found, together)
        ]
        return np.concatenate(found), np.concatenate(counts)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        places: list[int] = []
        ends = []
        whole = [i for i, text in enumerate(texts) if "  " in text]
        skip = set(whole)
        for i, text in enumerate(texts):
            if i not in skip:
                words = text.split(" ")
                words[0] = f" {words[0]}"
                places.extend(map(self.words.__getitem__, words))
            ends.append(len(places))
        ids, counts = self.words.numbers(np.array(places, np.int64))
        cuts = np.append(0, np.cumsum(counts))[np.array(ends, np.int64)]
        result = np.split(ids, cuts[:-1])
        for i, found in zip(whole, self._encode([texts[i] for i in whole])):
            result[i] = found
        self.words.end_batch()
        return result


@lru_cache(maxsize=1)
def tokenizer_at(path: str) -> CachedTokenizer:
    """The tokenizer of a worker process, which later tasks of it use again. Its cache of
    words refers to it, so one per task would pile up until the garbage collector comes."""
    return CachedTokenizer(path)


class SumOfSquares:
    """Open windows by fill level. ``place`` gives the level to put a piece at."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]

    def level_for(self, length: int) -> int:
        """Level (0: a new window) after which the sum of squares is least; ties: the fullest."""
        counts = self.counts
        last = self.window - length
        joined = 2 * counts[length : self.window + 1] + 1
        joined[last] = 0  # a full window is no longer open
        left = 1 - 2 * counts[: last + 1]
        left[0] = 0
        change = joined + left
        change[1:][counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def place(self, piece: tuple, length: int) -> list | None:
        """Put a piece into a window; the pieces of the window if that fills it."""
        level = self.level_for(length)
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        level += length
        if level == self.window:
            return pieces
        self.open[level].append(pieces)
        self.counts[level] += 1
        return None

    def rest(self) -> Iterator[tuple]:
        """Pieces of the windows that are still open, fullest first."""
        for level in range(self.window - 1, 0, -1):
            for pieces in self.open[level]:
                yield from pieces


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 1024,
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its token ids and then ``end_id``; null text counts as empty. Pieces
    of a sequence follow one another from offset 0. A sequence is unique to the task
    that filled it. Ids may be null or repeated: each row is packed as a document of
    its own. An empty table gives no rows. ``tokenizer_path`` must be there on all
    executors. Without ``with_ids`` the column ids is left out.
    """
    key = docs.schema[id_column]
    id_type = "string" if key.dataType.simpleString() == "string" else "bigint"
    schema = (
        f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids
    )

    @freeing
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(tokenizer_path)
        levels = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 32
        out: list[tuple] = []

        def close(pieces: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for key, start, ids, total in pieces:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                out.append((key, start, len(ids), crc, total, sequence, offset, ids))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            arrays = [pa.array(columns[0], pa.string() if id_type == "string" else pa.int64())]
            arrays += [pa.array(column, pa.int64()) for column in columns[1:7]]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=NAMES[: len(arrays)])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [text or "" for text in part.column(1).to_pylist()]
                for key, ids in zip(part.column(0).to_pylist(), tokenizer.ids(texts)):
                    ids = np.append(ids, end_id)
                    whole = len(ids) // window * window
                    for start in range(0, whole, window):
                        close([(key, start, ids[start : start + window], len(ids))])
                    if whole < len(ids):
                        piece = (key, whole, ids[whole:].copy(), len(ids))
                        if full := levels.place(piece, len(ids) - whole):
                            close(full)
                if len(out) >= 1000:
                    yield flush()
        room, pieces = window, []
        for key, start, ids, total in levels.rest():
            while len(ids):
                take = ids[:room]
                pieces.append((key, start, take, total))
                start, ids, room = start + len(take), ids[len(take) :], room - len(take)
                if not room:
                    close(pieces)
                    room, pieces = window, []
        if pieces:
            close(pieces)
        if out:
            yield flush()
        # The worker keeps the tokenizer, but not the words of this task.
        tokenizer.words.restart()

    own = docs.select(F.col(id_column).cast(id_type).alias("id"), F.col(text_column).alias("text"))
    return own.mapInArrow(packed, schema)


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
