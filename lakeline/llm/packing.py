"""Packing token sequences into windows by minimum bin slack.

Every document is tokenized, ended with the id 1 and cut into full windows and
one remainder. How to combine the remainders depends only on how many there are
of each length, a table of at most ``capacity`` rows whatever the corpus, so the
packing is planned on that histogram: a subset-sum program over bitsets picks
the multiset of remaining lengths that fills a window closest to its capacity,
and the multiset is applied as often as the counts allow. The plan says which
ranks of each length go to which windows; every piece then looks up its own
place. Ranks come from per-task counts, so no length, however common, is sorted
or gathered in one place.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.bpe import encoder
from lakeline.llm.tables import slices, store, texts

END_ID = 1
_RANK_BITS = 44  # the plan's key is length * 2**44 + rank

_PIECES = ("task int, doc_id long, start long, length long, ids_crc32 long, "
           "doc_tokens long, rank long")


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The largest length left, with the multiset of others that leaves least slack.

    ``reach[i]`` is the bitset of sums that the i longest lengths can make under
    their counts; walking it back yields how many of each length are taken.
    """
    left = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    first = left[0]
    room = capacity - first
    full = (1 << (room + 1)) - 1
    usable = [n for n in left if n <= room]
    reach = [1]
    seen: list[int] = []
    for n in usable:
        most = min(counts[n] - (n == first), room // n)
        bits, step = reach[-1], 1
        while most > 0:  # 1, 2, 4 ... copies: any number up to ``most``
            take = min(step, most)
            bits |= (bits << (n * take)) & full
            most -= take
            step *= 2
        reach.append(bits)
        seen.append(n)
        if bits >> room & 1:
            break
    total = reach[-1].bit_length() - 1
    chosen = {first: 1}
    for i in range(len(seen) - 1, -1, -1):
        n = seen[i]
        most = min(counts[n] - (n == first), room // n)
        for copies in range(most + 1):  # the fewest copies that longer lengths can complete
            if total >= copies * n and reach[i] >> (total - copies * n) & 1:
                break
        if copies:
            chosen[n] = chosen.get(n, 0) + copies
            total -= copies * n
    return chosen


def plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Rows (length, rank0, copies, sequence0, offset0): the items of ``length``
    ranked from ``rank0`` on go ``copies`` to a window, from window ``sequence0``.

    A pattern is applied until one of its lengths has too few items left, so the
    rows number a few per distinct length and not per item.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fill(left, capacity)
        times = min(left[n] // c for n, c in chosen.items())
        offset = 0
        for n, c in sorted(chosen.items(), reverse=True):
            rows.append((n, used[n], c, sequence, offset))
            used[n] += c * times
            left[n] -= c * times
            offset += n * c
            if not left[n]:
                del left[n]
        sequence += times
    out = pd.DataFrame(rows, columns=["length", "rank0", "copies", "sequence0", "offset0"], dtype="int64")
    return out.sort_values(["length", "rank0"], ignore_index=True)


def _cut(tokenizer_path: str, capacity: int):
    def run(batches):
        model = encoder(tokenizer_path)
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, text = batch.column(0), batch.column(1).to_pylist()  # ids stay Arrow: null or any long
            for a, b in slices(map(len, text), 3_000_000):
                flat, n = model.encode(text[a:b])
                out = []
                at = 0
                for doc, count in zip(range(a, b), n):
                    tokens = np.append(flat[at:at + count], np.uint32(END_ID)).astype("<u4")
                    at += count
                    for start in range(0, len(tokens), capacity):
                        piece = tokens[start:start + capacity]
                        out.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens)))
                cols = np.array([r[1:] for r in out], np.int64).T
                rank = np.empty(len(out), np.int64)
                order = np.argsort(cols[1], kind="stable")
                sizes, first, times = np.unique(cols[1][order], return_index=True, return_counts=True)
                rank[order] = np.arange(len(out)) - np.repeat(first, times) + np.repeat(ranks[sizes], times)
                ranks[sizes] += times
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(out), task, np.int32)),
                     ids.take(pa.array([r[0] for r in out], pa.int64())),
                     *map(pa.array, (cols[0], cols[1], cols[2], cols[3], rank))],
                    names=["task", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"])

    return run


def _place(entries: pd.DataFrame):
    key = entries["length"].to_numpy() * (1 << _RANK_BITS) + entries["rank0"].to_numpy()
    rank0, copies, sequence0, offset0 = (entries[c].to_numpy() for c in ("rank0", "copies", "sequence0", "offset0"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            i = np.searchsorted(key, length * (1 << _RANK_BITS) + rank, "right") - 1
            j = rank - rank0[i]
            sequence = sequence0[i] + j // copies[i]
            offset = offset0[i] + j % copies[i] * length
            cols = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """One row per piece of a document with its place in a window.

    ``docs``: doc_id, text; other columns are not read. A null text counts as
    empty: such a document is the single id 1. A null doc_id stays null on its
    pieces. Repeated rows and equal texts are packed as often as they occur. Of
    no rows come no rows.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    pieces = store(texts(docs).mapInArrow(_cut(tokenizer_path, capacity), _PIECES), "pack-pieces")
    by_task = pieces.groupBy("task", "length").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    entries = plan(counts, capacity)  # at most ``capacity`` lengths are collected
    ranked = pieces.join(first, ["task", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("first")).alias("rank"))
    return ranked.mapInArrow(
        _place(entries),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
