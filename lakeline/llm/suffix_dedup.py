"""Removal of later copies of byte strings through longest previous factors.

A suffix array over the stretches that may repeat puts equal windows next to each
other. Per suffix the nearest smaller documents before and after it in suffix
order, together with the longest common prefixes on the way, are its longest
previous factor: where that is a window long, an earlier document holds the same
window. Following these links to their end leads to the first document of all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeline.llm import repeats
from lakeline.llm.tables import texts

_CODE = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
_LATER = np.iinfo(np.int64).max  # no document is later


def _units(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(docs), np.uint8)
    return _CODE[data], np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)


def _raw(docs: list[bytes], units: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(docs), np.uint8)


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    s = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], s[1:] != s[:-1]]))
    return rank


def suffix_order(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin ``at``, by their first ``width`` bytes, and
    whether each shares all of these with the one before it in that order.

    Prefix doubling: ranks by 8 bytes, then by twice as many from two ranks each.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key, span = padded, 1
    while span < 8:
        key = (key[:-span] << np.uint64(8 * span)) | key[span:]
        span *= 2
    rank = _dense(key[:n])
    while 2 * span <= width:
        follow = np.zeros(n, np.int64)
        follow[:n - span] = rank[span:]
        rank = _dense(rank * n + follow)
        span *= 2
    key = rank[at] * n + rank[at + width - span]
    order = np.argsort(key)
    s = key[order]
    return order, np.concatenate([[False], s[1:] == s[:-1]])


def previous_smaller(value: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Position of the nearest smaller value before each one, -1 without; the
    search ends where ``joined`` is false (the common prefix is too short there).
    All positions chase at once: what another has skipped is no smaller either."""
    found = np.arange(-1, len(value) - 1)
    found[~joined] = -1
    open_ = np.flatnonzero(found >= 0)
    while len(open_):
        f = found[open_]
        open_ = open_[value[f] >= value[open_]]
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


def first_document(order: np.ndarray, same: np.ndarray, document: np.ndarray) -> np.ndarray:
    """For each suffix the smallest document that holds its window."""
    value = document[order]
    n = len(value)
    before = previous_smaller(value, same)
    after = n - 1 - previous_smaller(value[::-1], np.concatenate([[False], same[:0:-1]]))[::-1]
    link = np.where(before >= 0, before, np.where(after < n, after, np.arange(n)))
    while True:
        far = link[link]
        if (far == link).all():
            break
        link = far
    out = np.empty(n, document.dtype)
    out[order] = value[link]
    return out


def judge(width: int) -> repeats.Judge:
    def run(data, cuts, times, least, most):
        count = np.diff(cuts) - width + 1
        edges = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(edges[-1]) + np.repeat(cuts[:-1] - edges[:-1], count)
        order, same = suffix_order(data, at, width)
        first = first_document(order, same, np.repeat(least, count))
        several = np.zeros(len(at), bool)
        several[order] = np.concatenate([same[1:], [False]]) | same
        return first, (least < most) | (np.add.reduceat(several.astype(np.int64), edges[:-1]) > 0)

    return repeats.Judge(lambda times, least, most: (least, least < most), run)


def _digest(width: int):
    def run(batches):
        for batch in batches:
            rows = []
            starts, first, cuts = repeats.hit_windows(batch.column(4), np.int64)
            for i, (at, text, copy) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                data = text.encode()
                if copy:  # an earlier document has the whole text
                    rows.append((len(data), len(data), 1, hashlib.sha256().hexdigest(), ""))
                    continue
                own = slice(cuts[i], cuts[i + 1])
                later = starts[own][first[own] < at]
                if not len(later):
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), text))
                    continue
                edge = np.bincount(later, minlength=len(data) + 1)
                edge[width:] -= edge[:-width].copy()
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                rows.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(),
                             kept.decode("utf-8", "ignore")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
                 *(pa.array([r[i] for r in rows], pa.string()) for i in (3, 4)), *batch.columns[5:]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", *batch.schema.names[5:]])

    return run


def remove_later_copies(docs: DataFrame, width: int = 50, carry: bool = False) -> DataFrame:
    """Each document without the bytes that an earlier one already holds.

    ``docs``: doc_id, text; other columns are not read. A byte goes when it lies in
    a string of ``width`` bytes that also starts in a document with a smaller
    doc_id; strings are judged on the input and never cross documents. A null text
    is empty. A null doc_id counts as the smallest and stays null; rows that
    repeat a doc_id never lose anything to each other. No rows give no rows.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_text (what
    is left; a character of which only a part is left is dropped from it), with
    ``carry`` also ``row``, a struct of the row's other columns.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("doc_id", "text")]
    rows = repeats.with_key(texts(docs))
    full = repeats.with_key(texts(docs, F.struct(*others).alias("row"))) if carry and others else rows
    amount = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    gram = width // 2 - 1
    texts_of = repeats.same_texts(rows)
    anchors = repeats.shared_anchors(rows, _units, width, gram, amount)
    found = repeats.stretches(rows, texts_of, anchors, _units, width, gram, _raw)
    judged = repeats.verdicts(found, judge(width), width, 1, np.int64(_LATER))
    hits = repeats.marks(found, judged, F.col("value") < F.col("at"))
    copies = texts_of.filter((F.col("at") > F.col("first")) & (F.col("size") >= width)) \
        .select("at", "same", F.lit(True).alias("copy")).distinct()
    marked = copies.join(hits, ["at", "same"], "full")
    joined = full.join(marked, ["at", "same"], "left").select(
        "doc_id", "at", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "hits", *full.columns[4:])
    schema = StructType.fromDDL(
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return joined.mapInArrow(_digest(width), StructType(schema.fields + joined.schema.fields[5:]))
