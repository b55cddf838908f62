"""Language identification by rank-order profiles of n-grams.

A language's profile is its most frequent n-grams of one to three letters (words padded
with a blank) in order of frequency. A document's own most frequent n-grams are compared
with each profile by the out-of-place distance: the sum of the differences in rank, an
n-gram that the profile lacks counting as far as possible.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainlane.llm.common import freeing, with_row
from rainlane.llm.wordcache import WordCache
from rainlane.staging import stage

UNDETERMINED = "und"
PROFILE_SIZE = 300
BLANK = ord(" ")
LETTERS = re.compile(r"[^\W\d_]+")
MOST_GRAMS = 500_000
TEXTS_AT_ONCE = 64
WORDS_AT_ONCE = 100_000


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of all words one after another, and how many each word has; a
    code packs up to three code points."""
    parts = [LETTERS.findall(word.lower()) for word in words]
    line = " " + " ".join(part for own in parts for part in own) + " "
    points = np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.int64)
    first, second = points[:-1], points[1:]
    third = np.append(points[2:], 0)
    pair = first << 42 | second << 21
    codes = np.stack([first << 42, pair, pair | third], axis=1)
    valid = np.stack([first != BLANK, second != BLANK, second != BLANK], axis=1)
    valid[:, 1] |= first != BLANK
    valid[-1, 2] = False
    if len(points) <= 2:
        valid[:] = False
    flat = codes[valid]
    # A word's n-grams are those that begin between its blank and the next word's.
    begins = np.append(np.flatnonzero(first == BLANK), len(first))
    seen = np.append(0, np.cumsum(valid.sum(axis=1)))
    ends = np.cumsum([len(own) for own in parts])
    cuts = seen[begins[np.minimum(ends, len(begins) - 1)]]
    return flat, np.diff(cuts, prepend=0)


def gram_ids(ids: dict[int, int], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``gram_codes`` as the numbers that ``ids`` has for them; new codes get the next ones."""
    codes, counts = gram_codes(words)
    found, back = np.unique(codes, return_inverse=True)
    numbers = [ids.setdefault(code, len(ids)) for code in found.tolist()]
    return np.array(numbers, np.int64)[back], counts


class GramIds:
    """N-gram codes as small numbers, which a task hands out as it meets them."""

    def __init__(self):
        self.restart()

    def restart(self) -> None:
        self.ids: dict[int, int] = {}
        # The cache must not refer back to this object, or both would outlive their task
        # until the garbage collector comes to them.
        self.words = WordCache(partial(gram_ids, self.ids), most_words=150_000)

    def counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """How often each n-gram occurs in each text, by number. Memory is bounded by a
        slice of the words of one text, whatever its length."""
        self.words.end_batch()
        places = [
            np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            for words in (text.split() for text in texts)
        ]
        self.words.numbers(np.zeros(0, np.int64))
        for own in places:
            total = np.zeros(len(self.ids), np.int64)
            for at in range(0, len(own), WORDS_AT_ONCE):
                ids, _ = self.words.numbers(own[at : at + WORDS_AT_ONCE])
                total += np.bincount(ids, minlength=len(self.ids))
            yield total

    def codes(self) -> np.ndarray:
        return np.fromiter(self.ids, np.int64, len(self.ids))

    def full(self) -> bool:
        return len(self.ids) > MOST_GRAMS


@dataclass(frozen=True)
class Profiles:
    """Languages in order of name, and the codes of each profile in order of rank."""

    languages: tuple[str, ...]
    codes: tuple[tuple[int, ...], ...]
    size: int = PROFILE_SIZE


def count_grams(docs: DataFrame, text_column: str, language_column: str) -> DataFrame:
    """Columns lang, code, n: n-grams of all whole texts by language."""

    @freeing
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, totals = GramIds(), {}

        def flush() -> Iterator[pa.RecordBatch]:
            codes = grams.codes()
            for lang, counts in totals.items():
                at = np.flatnonzero(counts)
                arrays = [pa.array([lang] * len(at), pa.string()), pa.array(codes[at]), pa.array(counts[at])]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "code", "n"])
            totals.clear()
            grams.restart()

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                langs = part.column(1).to_pylist()
                for lang, own in zip(langs, grams.counts(part.column(0).to_pylist())):
                    before = totals.get(lang, np.zeros(0, np.int64))
                    own[: len(before)] += before
                    totals[lang] = own
                if grams.full():
                    yield from flush()
        yield from flush()

    known = docs.select(
        F.col(text_column).alias("text"), F.col(language_column).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    parts = known.mapInArrow(counted, "lang string, code long, n long")
    return parts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def learn_profiles(
    docs: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    size: int = PROFILE_SIZE,
    most_languages: int = 1000,
) -> Profiles:
    """Profiles from all rows with text and language; of equally frequent n-grams the one
    with the smaller code points is first. A language none of whose texts has a letter has
    no profile. Of more than ``most_languages`` names, as in a column that holds anything,
    those with the most n-grams (ties: by name) are learned. What comes to the driver is at
    most ``size`` numbers for each of them."""
    counts = stage(count_grams(docs, text_column, language_column), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    learned = totals.orderBy(F.desc("total"), "lang").limit(most_languages).select("lang")
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= size)
    found: dict[str, list] = {}
    for row in top.join(F.broadcast(learned), "lang").select("lang", "rank", "code").collect():
        found.setdefault(row.lang, []).append((row.rank, row.code))
    languages = sorted(found)
    return Profiles(tuple(languages), tuple(tuple(c for _, c in sorted(found[lang])) for lang in languages), size)


class Ranker:
    """Distances of documents to profiles."""

    def __init__(self, profiles: Profiles):
        self.profiles = profiles
        self.grams = GramIds()
        self.ranks_of = [{c: rank for rank, c in enumerate(own)} for own in profiles.codes]
        self._codes, self._ranks = self._ranked(np.zeros(0, np.int64))

    def _ranked(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.profiles.size
        found = [[own.get(c, size) for c in codes.tolist()] for own in self.ranks_of]
        return codes, np.array(found, np.int64).reshape(len(found), len(codes))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """Language, score, 1 less the distance's share of the largest one possible, and the
        number of n-grams that were compared."""
        size, result = self.profiles.size, []
        for counts in self.grams.counts([text or "" for text in texts]):
            if len(self._codes) != len(counts):
                self._codes, self._ranks = self._ranked(self.grams.codes())
            at = np.flatnonzero(counts)
            if not len(at) or not self.profiles.languages:
                result.append((UNDETERMINED, 0.0, 0))
                continue
            if len(at) > size:
                least = np.partition(counts[at], len(at) - size)[len(at) - size]
                at = at[counts[at] >= least]
            at = at[np.lexsort((self._codes[at], -counts[at]))][:size]
            ranks = self._ranks[:, at]
            places = np.arange(len(at))
            apart = np.where(ranks == size, size, np.abs(ranks - places)).sum(axis=1)
            best = int(np.argmin(apart))
            score = 1 - apart[best] / (size * len(at))
            result.append((self.profiles.languages[best], float(score), len(at)))
        if self.grams.full():
            self.grams.restart()
            self._codes, self._ranks = self._ranked(np.zeros(0, np.int64))
        return result


def identify(docs: DataFrame, profiles: Profiles, text_column: str = "text") -> DataFrame:
    """Columns row (all columns of ``docs``, as they are), lang_pred, score and n_grams (how many
    different n-grams of the text were compared, at most the size of a profile).

    Each whole text is read. A null text, one without a letter, and any text where no
    profile was learned is ``und`` with score 0. Of languages equally far the first by
    name is taken. An empty table gives no rows.
    """

    @freeing
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles)
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                found += ranker.predict(batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist())
            langs, scores, sizes = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32())],
                names=["row", "lang_pred", "score", "n_grams"],
            )

    given = docs.select(F.struct("*").alias("row"), F.col(text_column).alias("text"))
    return given.mapInArrow(predicted, with_row(given, "lang_pred string, score double, n_grams int"))
