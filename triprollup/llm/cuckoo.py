"""A cuckoo filter over 64-bit keys, with whole arrays of keys inserted or removed at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Share of slots in use beyond which a filter is made larger.
MAX_LOAD = 0.85
#: Rounds of moving keys on before an insertion gives up and the filter must grow.
MAX_ROUNDS = 500
#: A fixed odd multiplier that spreads fingerprints over buckets.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may lie in either of two buckets.

    A key that was inserted is always found, another one with a chance of about 8 / 65,535.
    Only inserted keys may be removed. Keys inserted twice must be removed twice.
    """

    def __init__(self, buckets: int = 1, table: bytes | None = None):
        if table is None:
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """A power of two of buckets that n keys load to half or more, below the bound."""
        return cls(1 << max(0, int(np.ceil(np.log2(max(n, 1) / (SLOTS * MAX_LOAD))))))

    def holds(self, n: int) -> bool:
        return n <= self.table.size * MAX_LOAD

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _prints(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.astype(np.uint64)
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, buckets: np.ndarray, prints: np.ndarray) -> np.ndarray:
        spread = (prints.astype(np.uint64) * SPREAD) >> np.uint64(20)
        return buckets ^ (spread & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _claim(self, prints: np.ndarray, buckets: np.ndarray, wanted: np.ndarray, write: bool):
        """Give each key a slot of its bucket that holds `wanted`; tell which keys got none.

        Keys that want the same of a bucket get its first, second, ... such slot.
        """
        want = buckets * 65_536 + wanted
        order = np.argsort(want, kind="stable")
        want, bucket = want[order], buckets[order]
        rank = np.arange(len(order)) - np.searchsorted(want, want)
        nth = np.cumsum(self.table[bucket] == wanted[order][:, None], axis=1)
        got = nth[:, -1] > rank
        slot = np.argmax(nth > rank[:, None], axis=1)
        self.table[bucket[got], slot[got]] = prints[order[got]] if write else 0
        return np.sort(order[~got])

    def insert(self, keys: np.ndarray) -> bool:
        """False if there is no room; the filter must then be built anew, larger."""
        prints, here = self._prints(keys)
        rng = np.random.default_rng(1)
        for _ in range(MAX_ROUNDS):
            left = self._claim(prints, here, np.zeros_like(here), write=True)
            prints, here = prints[left], here[left]
            there = self._other(here, prints)
            left = self._claim(prints, there, np.zeros_like(there), write=True)
            prints, here = prints[left], here[left]
            if not len(prints):
                return True
            # In each full bucket one key takes the place of another, which moves on to the
            # other's second bucket, and if need be pushes out a third from there.
            first = np.unique(here, return_index=True)[1]
            slot = rng.integers(SLOTS, size=len(first))
            out = self.table[here[first], slot]
            self.table[here[first], slot] = prints[first]
            prints[first], here[first] = out, self._other(here[first], out)
        return False

    def remove(self, keys: np.ndarray) -> None:
        prints, here = self._prints(keys)
        left = self._claim(prints, here, prints.astype(np.int64), write=False)
        there = self._other(here[left], prints[left])
        if len(self._claim(prints[left], there, prints[left].astype(np.int64), write=False)):
            raise ValueError("a key to be removed is not in the filter")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, here = self._prints(keys)
        there = self._other(here, prints)
        wanted = prints[:, None]
        return ((self.table[here] == wanted) | (self.table[there] == wanted)).any(axis=1)
