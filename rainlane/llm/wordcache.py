"""Words to arrays of numbers, worked out once per distinct word and task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class WordCache(dict):
    """Word -> place in a ragged table of numbers.

    ``encode`` gets the new words of a batch and gives their numbers one after another, and
    how many each word has.
    The cache starts anew beyond ``most_words`` or ``most_chars``, between batches, so
    its memory is bounded; results don't depend on what it holds.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        most_words: int = 400_000,
        most_chars: int = 8_000_000,
    ):
        super().__init__()
        self.encode, self.most_words, self.most_chars = encode, most_words, most_chars
        self.restart()

    def restart(self) -> None:
        """Forget all words, and free what they took."""
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.starts = np.zeros(1, np.int64)
        self.values = np.zeros(0, np.int32)

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return place

    def numbers(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of each place one after another, and how many each place has."""
        if self.new:
            values, sizes = self.encode(self.new)
            self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(sizes))
            self.values = np.append(self.values, values.astype(np.int32))
            self.new = []
        counts = self.starts[places + 1] - self.starts[places]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[places] - (ends - counts), counts) + np.arange(total)
        return self.values[at], counts

    def end_batch(self) -> None:
        if len(self) > self.most_words or self.chars > self.most_chars:
            self.restart()
