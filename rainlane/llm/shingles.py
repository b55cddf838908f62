"""Sets of hashed word shingles of whole texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
SLICE = 4 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64 bits of a hash of a word with A-Z in lower case; starts anew when it gets large."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        found = hashlib.blake2b(word.lower(), digest_size=8).digest()
        value = self[word] = int.from_bytes(found, "little")
        return value

    def of_text(self, text: str) -> np.ndarray:
        """Hashes of all words, that is of runs of anything but ASCII blanks."""
        if len(self) > self.MOST:
            self.clear()
        parts = [np.zeros(0, np.uint64)]
        for piece in _slices(text.encode("utf-8", "surrogatepass")):
            words = piece.split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
        return np.concatenate(parts)


def _slices(content: bytes) -> Iterator[bytes]:
    """The content cut at blanks, so that the words of one slice at a time are in memory."""
    at = 0
    while at < len(content):
        cut = BLANK.search(content, at + SLICE)
        end = cut.start() if cut else len(content)
        yield content[at:end]
        at = end


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * FACTOR
    return values ^ (values >> np.uint64(29))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; fewer words are one run as a whole."""
    if not len(words):
        return words
    size = min(width, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        runs = _mixed(runs * FACTOR + words[k : k + len(runs)])
    return np.unique(_mixed(runs + np.uint64(size)))
