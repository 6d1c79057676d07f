"""Fill-in-the-middle: texts reordered around two cuts at token boundaries.

A text's boundaries (the offsets in code points after each token, and 0) are kept as
a Roaring-style set, whose select gives the offset after any number of tokens. Python
sees a text once, in Arrow batches, and returns two numbers; hashing, cutting and
joining are Spark's own functions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm import words
from lakeline.llm.boundaries import BoundarySet
from lakeline.llm.tables import slices

MARKS = ("<P>", "<S>", "<M>")
SEED = 42
RATE = 50  # of 100 texts that are reordered
SPM = 80  # of 100 reordered texts that have the suffix first
SLICE = 4_000_000  # bytes of text handled at a time


def boundary_offsets(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points before the end of every token of all texts, one text after another,
    counted from its text's start, and the number of tokens of each text.

    A token is a word with the blanks before it, or the blanks at the end of a text."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(sizes)
    word = words.BLANKS[data]
    last = np.zeros(len(data), bool)
    last[:-1] = word[:-1] & ~word[1:]
    last[ends[sizes > 0] - 1] = True
    at = np.flatnonzero(last)
    points = np.cumsum((data & 0xC0) != 0x80)
    before = np.concatenate([[0], points])[ends - sizes]
    owner = np.searchsorted(ends, at, "right")
    return points[at] - before[owner], np.bincount(owner, minlength=len(raw))


def cuts(raw: list[bytes], one: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int]]:
    """(tokens, prefix's code points, middle's code points) of each text; the cuts come
    after ``one`` and ``other`` modulo (tokens + 1) tokens, the smaller first."""
    offsets, n = boundary_offsets(raw)
    stop = np.cumsum(n)
    a, b = one % (n + 1), other % (n + 1)
    out = []
    for begin, end, i, j in zip(stop - n, stop, np.minimum(a, b).tolist(), np.maximum(a, b).tolist()):
        inside = BoundarySet(np.concatenate([[0], offsets[begin:end]]))
        prefix = inside.select(i)
        out.append((int(end - begin), prefix, inside.select(j) - prefix))
    return out


_CUTS = "struct<n: bigint, prefix_chars: bigint, middle_chars: bigint>"


def _cut(text: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    raw = text.cast(pa.large_binary()).to_pylist()
    one, other = one.to_numpy(zero_copy_only=False), other.to_numpy(zero_copy_only=False)
    rows = [r for a, b in slices(map(len, raw), SLICE) for r in cuts(raw[a:b], one[a:b], other[a:b])]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
    return pa.StructArray.from_arrays(columns, names=["n", "prefix_chars", "middle_chars"])


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the hash of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
                   marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every row.

    ``docs``: doc_id, text; other columns are not read, whatever their names. Tokens
    are words with the blanks before them; blanks at the end are one more token. The
    cuts are drawn from doc_id and ``seed``, so rows that repeat a doc_id draw alike.
    Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm``
    (suffix, prefix, middle), each part after its mark. Empty texts and texts that hold
    a mark are plain, so :func:`restore` is exact. A null text counts as empty; a null
    doc_id draws from the empty string and stays null. No rows give no rows.
    """
    if len(set(marks)) < 3 or not all(m and m[0] not in other[1:] for m in marks for other in marks):
        raise ValueError("three different marks, whose first characters stand nowhere else in them, are needed")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    plain = (F.col("text") == "") | (h3 % 100 >= rate)
    for mark in marks:
        plain = plain | F.contains("text", F.lit(mark))
    rows = rows.select("doc_id", "text", F.arrow_udf(_cut, _CUTS)("text", h1, h2).alias("cut"),
                       F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm").alias("form"))
    first, second = F.col("cut.prefix_chars").cast("int"), F.col("cut.middle_chars").cast("int")
    prefix = F.substring("text", F.lit(1), first)
    middle = F.substring("text", first + 1, second)
    suffix = F.substring("text", first + second + 1, F.char_length("text"))
    p, s, m = (F.lit(mark) for mark in marks)
    moved = F.col("form") != "plain"
    return rows.select(
        "doc_id", F.col("cut.n").alias("n"), "form",
        F.when(moved, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(moved, F.col("cut.middle_chars")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text")).alias("output"))


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` of."""
    p, s, m = (F.instr(output, mark) for mark in marks)
    size = [len(mark) for mark in marks]
    rest = F.char_length(output)

    def between(begin: Column, skip: int, end: Column) -> Column:
        return F.substring(output, begin + skip, end - begin - skip)

    middle = F.substring(output, m + size[2], rest)
    psm = F.concat(between(p, size[0], s), middle, between(s, size[1], m))
    spm = F.concat(between(p, size[0], m), middle, between(s, size[1], p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
