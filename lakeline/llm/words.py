"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

import numpy as np

_VALUE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

BLANKS = np.ones(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = False  # words of [^\x20\x09-\x0D]+

LETTERS = np.zeros(256, bool)  # words of ASCII letters, digits, underscores and bytes of other characters (callers blank out marks among those)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def find(docs: list[bytes], inside: np.ndarray):
    """Joined bytes, start and end of every word in them, and the words of each text
    as ranges: (data, starts, ends, bounds)."""
    joined = b" ".join(docs) + b" "
    data = np.frombuffer(joined, np.uint8)
    word = inside[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    size = np.fromiter(map(len, docs), np.int64, len(docs)) + 1
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(size)]))
    return data, starts, ends, bounds.astype(np.int64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64)
    cuts = np.cumsum(size) - size
    index = np.arange(int(size.sum()), dtype=np.int64)
    offset = index - np.repeat(cuts, size)
    power = np.full(int(size.max()), _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    h = np.add.reduceat(_VALUE[data[index + np.repeat(starts - cuts, size)]] * power[offset], cuts)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
