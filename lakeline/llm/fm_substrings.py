"""Removal of repeated word windows, counted by backward search in FM-indexes.

Each group of candidate stretches becomes a compressed FM-index: a suffix array's
Burrows-Wheeler transform in a wavelet matrix of packed bits. The stretches are
then streamed against it. A backward search for every window at once narrows
intervals of suffixes word by word; those whose interval no longer stands for two
occurrences drop out, the rest are matching statistics of at least the window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm import repeats, words
from lakeline.llm.tables import texts


class Bits:
    """Packed bits with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Occurrences of a symbol before a position, one bit level at a time."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.levels, self.zeros = [], []
        for level in range(depth - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.uint8)
            self.levels.append(Bits(bit))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.depth = depth

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``at`` may hold several rows of positions for one row of symbols."""
        low = np.zeros_like(symbol)
        for i, bits in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - i) & 1).astype(bool)
            r, base = bits.rank(at), bits.rank(low)
            at = np.where(one, r + self.zeros[i], at - r)
            low = np.where(one, base + self.zeros[i], low - base)
        return at - low


class FMIndex:
    """Index of sequences with weights; a match counts with its sequence's weight."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray):
        k = len(sequences)
        size = np.array([len(s) for s in sequences], np.int64)
        flat = np.concatenate(sequences)
        self.alphabet, code = np.unique(flat, return_inverse=True)
        n = len(flat) + k
        ends = np.cumsum(size + 1) - 1
        text = np.empty(n, np.int64)
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = code + k  # symbols 0..k-1 end the sequences and are all different
        text[ends] = np.arange(k)
        self.first = k
        suffixes = _suffix_array(text)
        before = text[suffixes - 1]
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=k + len(self.alphabet)))])
        depth = max(1, int(k + len(self.alphabet) - 1).bit_length())
        self.matrix = WaveletMatrix(before, depth)
        weight = np.repeat(weights, size + 1)
        self.weight = np.concatenate([[0], np.cumsum(weight[suffixes])])
        self.n = n

    def counts(self, flat: np.ndarray, starts: np.ndarray, width: int, least: int = 2) -> np.ndarray:
        """Weighted occurrences of the window at each start; 0 once below ``least``."""
        at = np.searchsorted(self.alphabet, flat)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == flat
        code = np.where(known, at + self.first, -1)
        out = np.zeros(len(starts), np.int64)
        live = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n)
        for step in range(width - 1, -1, -1):
            c = code[starts[live] + step]
            ok = c >= 0
            live, low, high, c = live[ok], low[ok], high[ok], c[ok]
            both = self.matrix.rank(c, np.stack([low, high]))
            low, high = self.less[c] + both[0], self.less[c] + both[1]
            ok = self.weight[high] - self.weight[low] >= least
            live, low, high = live[ok], low[ok], high[ok]
            if not len(live):
                break
        out[live] = self.weight[high] - self.weight[low]
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    rank, span, n = text, 1, len(text)
    while True:
        key = rank * (n + 1)
        key[:n - span] += rank[span:] + 1
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], s[1:] != s[:-1]]))
        if rank[order[-1]] == n - 1:
            return order
        span *= 2


def judge(width: int) -> repeats.Judge:
    def run(data, cuts, times, least, most):
        flat = np.frombuffer(data.tobytes(), np.uint64)
        index = FMIndex([flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], times)
        count = np.diff(cuts) - width + 1
        edges = np.concatenate([[0], np.cumsum(count)])
        starts = np.arange(edges[-1]) + np.repeat(cuts[:-1] - edges[:-1], count)
        again = np.repeat(times > 1, count)  # every window of such a stretch repeats with it
        asked = np.flatnonzero(~again)
        again[asked] = index.counts(flat, starts[asked], width) > 1
        return again.astype(np.uint8), np.add.reduceat(again.astype(np.int64), edges[:-1]) > 0

    return repeats.Judge(lambda times, least, most: (np.ones(len(times), np.int64), times > 1), run)


def _units(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, starts, ends, bounds = words.find(docs, words.BLANKS)
    return words.hashes(data, starts, ends), bounds


def _raw(docs: list[bytes], units: np.ndarray) -> np.ndarray:
    return units


def _digest(width: int):
    def run(batches):
        for batch in batches:
            rows = []
            windows, again, cuts = repeats.hit_windows(batch.column(3), np.uint8)
            for i, (text, copy) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                data = text.encode()
                _, starts, ends, _ = words.find([data], words.BLANKS)
                own = slice(cuts[i], cuts[i + 1])
                repeated = windows[own][again[own] > 0]
                gone = np.full(len(starts), copy and len(starts) >= width)  # a copy's windows all repeat
                if len(repeated) and not gone.any():
                    edge = np.bincount(repeated, minlength=len(starts) + 1)
                    edge[width:] -= edge[:-width].copy()
                    gone = np.cumsum(edge[:-1]) > 0
                kept = b" ".join([data[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist())])
                rows.append((len(starts), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(2)),
                 *(pa.array([r[i] for r in rows], pa.string()) for i in (2, 3))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def remove_repeated_windows(docs: DataFrame, width: int = 35) -> DataFrame:
    """Each document without the words of windows that occur more than once.

    ``docs``: doc_id, text; other columns are not read. A word is a run of
    characters other than space and U+0009 to U+000D. A window of ``width`` words
    in a row of one document that also starts anywhere else, in this document or
    another row, loses all its words, wherever it occurs; windows are judged on the
    input. A null text has no words. Rows count as often as they repeat, so a
    repeated row of ``width`` words or more loses them all. A null doc_id stays
    null. No rows give no rows.

    Returns doc_id, n_words, n_removed, kept_sha256, kept_text (words left, joined
    by one space).
    """
    rows = repeats.with_key(texts(docs))
    amount = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    gram = max(1, width // 2 - 1)
    texts_of = repeats.same_texts(rows)
    anchors = repeats.shared_anchors(rows, _units, width, gram, amount // 8)
    found = repeats.stretches(rows, texts_of, anchors, _units, width, gram, _raw)
    judged = repeats.verdicts(found, judge(width), width, 8, np.uint8(0))
    hits = repeats.marks(found, judged)
    copies = texts_of.filter("rows > 1").select("at", "same", F.lit(True).alias("copy")).distinct()
    marked = copies.join(hits, ["at", "same"], "full")
    return rows.join(marked, ["at", "same"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "hits").mapInArrow(
        _digest(width), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
