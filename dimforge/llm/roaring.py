"""A compressed set of ascending offsets with select.

Offsets are split by their high 16 bits; the low 16 bits of a chunk lie in the
smallest of three containers: a sorted array, a bitmap or a list of runs.
``cumulative`` counts the offsets up to the end of each container, so the k-th
offset is found by a binary search for its container and a select inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 16
_WORDS = CHUNK // 64


@dataclass(frozen=True)
class ArrayContainer:
    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])

    @property
    def n_bytes(self) -> int:
        return 2 * len(self.values)


@dataclass(frozen=True)
class BitmapContainer:
    words: np.ndarray
    #: offsets up to the end of each word
    counts: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> "BitmapContainer":
        words = np.zeros(_WORDS, dtype=np.uint64)
        np.bitwise_or.at(words, low >> 6, np.uint64(1) << (low & 63).astype(np.uint64))
        return cls(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.counts, k, side="right"))
        word, left = int(self.words[at]), k - (int(self.counts[at - 1]) if at else 0)
        for _ in range(left):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1

    @property
    def n_bytes(self) -> int:
        return CHUNK // 8


@dataclass(frozen=True)
class RunContainer:
    starts: np.ndarray
    #: offsets up to the end of each run
    counts: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.counts, k, side="right"))
        return int(self.starts[at]) + k - (int(self.counts[at - 1]) if at else 0)

    @property
    def n_bytes(self) -> int:
        return 4 * len(self.starts)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of ascending distinct values below 65,536."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), CHUNK // 8):
        return RunContainer(low[first].astype(np.uint16), np.append(first[1:], len(low)))
    if 2 * len(low) <= CHUNK // 8:
        return ArrayContainer(low.astype(np.uint16))
    return BitmapContainer.of(low)


class OffsetSet:
    """Ascending distinct offsets; ``select(k)`` is the k-th, counted from 0."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[cuts]
        self.cumulative = np.append(cuts[1:], len(offsets)) if len(cuts) else np.zeros(0, dtype=np.int64)
        self.containers = [container(part & (CHUNK - 1)) for part in np.split(offsets, cuts[1:])] if len(cuts) else []

    def __len__(self) -> int:
        return int(self.cumulative[-1]) if len(self.cumulative) else 0

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.cumulative, k, side="right"))
        before = int(self.cumulative[at - 1]) if at else 0
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - before)
