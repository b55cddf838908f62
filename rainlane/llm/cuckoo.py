"""A cuckoo filter over 64-bit hashes: insert, delete, and look up many at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOST_MOVES = 500
MIX = np.uint64(0x9E3779B97F4A7C15)


class Full(Exception):
    """No room for another fingerprint; the filter has to be built anew, and larger."""


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a fingerprint has two possible buckets.

    An inserted hash is always found. A hash that is not there is found with a chance of
    about 8 in 65,535. Only what was inserted may be deleted.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def for_count(cls, count: int) -> CuckooFilter:
        """Empty, with room for ``count`` hashes at a load of at most 0.8."""
        buckets = 1
        while buckets * SLOTS * 0.8 < count:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        count = len(hashes)
        while True:
            made = cls.for_count(count)
            try:
                made.insert(hashes)
                return made
            except Full:
                count = 2 * count + 4

    @classmethod
    def from_bytes(cls, content: bytes) -> CuckooFilter:
        return cls(np.frombuffer(content, "<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _prints(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = hashes.astype(np.int64).view(np.uint64)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes * MIX >> np.uint64(20)) & self.mask

    def _other(self, buckets: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return buckets ^ ((prints.astype(np.uint64) * MIX >> np.uint64(20)) & self.mask)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first = self._prints(hashes)
        second = self._other(first, prints)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(axis=1) | (self.table[second] == wanted).any(axis=1)

    def insert(self, hashes: np.ndarray) -> None:
        prints, first = self._prints(hashes)
        second = self._other(first, prints)
        for own, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            self._insert(own, a, b)

    def _insert(self, own: int, a: int, b: int) -> None:
        for bucket in (a, b):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = own
                return
        bucket = a
        for move in range(MOST_MOVES):
            slot = (own + move) % SLOTS
            own, self.table[bucket, slot] = int(self.table[bucket, slot]), own
            bucket = int(self._other(np.array([bucket], np.uint64), np.array([own], np.uint16))[0])
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = own
                return
        raise Full

    def delete(self, hashes: np.ndarray) -> None:
        prints, first = self._prints(hashes)
        second = self._other(first, prints)
        for own, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == own)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                raise KeyError("a hash to delete was never inserted")
