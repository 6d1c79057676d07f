"""A set of offsets in containers of 2**16, with rank directories for select.

The containers are those of Roaring bitmaps: sorted 16-bit values, a bitmap, or runs
of consecutive values, whichever is smallest. The number of values before each
container is kept, so the k-th value is found by one search over the containers and
one selection inside a single one.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 16
_WORDS = SPAN // 64
_ARRAY_LIMIT = 4096  # fixed value: from here on 16-bit values outgrow a bitmap's 8192 bytes


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, "right"))
        left = k - (int(self.upto[word - 1]) if word else 0)
        bits = np.flatnonzero(np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little"))
        return word * 64 + int(bits[left])


class RunContainer:
    def __init__(self, low: np.ndarray, breaks: np.ndarray):
        first = np.concatenate([[0], breaks])
        self.start = low[first].astype(np.uint16)
        self.before = first.astype(np.int64)  # values in the runs before each

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


def _container(low: np.ndarray):
    """The smallest of the three for sorted distinct values below ``SPAN``."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    if 4 * (len(breaks) + 1) < min(2 * len(low), 8192):
        return RunContainer(low, breaks)
    return ArrayContainer(low) if len(low) <= _ARRAY_LIMIT else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct non-negative integers."""

    def __init__(self, values: np.ndarray):
        if not len(values) or values[-1] < SPAN:
            cuts = np.array([0, len(values)] if len(values) else [0])
        else:
            high = values >> 16
            cuts = np.concatenate([[0], np.flatnonzero(high[1:] != high[:-1]) + 1, [len(values)]])
        self.base = [int(values[a]) >> 16 << 16 for a in cuts[:-1]]
        self.containers = [_container(values[a:b] - base) for a, b, base in zip(cuts[:-1], cuts[1:], self.base)]
        self.before = cuts  # values in the containers before each, and all of them at the end

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th value, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.before, k, "right")) - 1
        return self.base[c] + self.containers[c].select(k - int(self.before[c]))
