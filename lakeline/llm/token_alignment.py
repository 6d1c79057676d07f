"""Alignment of two tokenizers' ids over the same bytes, and which ids belong together.

Inside a task the work is a pipeline of Arrow tables over a slice of texts: the two
lists of ids are flattened, with the index of each one's text beside it; a segmented
cumulative sum of the tokens' lengths gives where each ends; a hash join on
(text, end) finds the tokens of either side that end together. Those ends cut a text
into groups, and each joined pair is a link. ``group_by`` counts a slice's pairs of
ids; Spark merges these partial counts. A slice then asks for the counts of the pairs
it holds, each once, so a pair that stands in every text crosses the shuffle once a
slice and never once a text.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.bpe import byte_of_character, encoder
from lakeline.llm.tables import slices, store

SLICE = 2_000_000  # bytes of text handled, and asked for, together
_LOW = (1 << 32) - 1

_TOKENS = ("slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<int>, "
           "pair long, place int, n long")
_FIELDS = ["slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pair", "place", "n"]
_KINDS = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64()]


class _Vocabularies:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        of = byte_of_character()
        a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a[i] = bytes(of.get(c, 0) for c in token)
        b = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
             for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.bytes_a, self.bytes_b = (pa.array(x, pa.large_binary()) for x in (a, b))
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        # every id as decimal digits, before each of the three separators
        self.digits = pa.array([f"{i}{sep}" for i in range(max(len(a), len(b))) for sep in ",|;"], pa.large_string())

    def ids(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of " " + text by the first and of text by the second, one list a text."""
        flat, n = self.a.encode([" " + t for t in texts])
        first = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]), pa.array(flat.astype(np.int64)))
        second = pa.array(self.b.encode(texts, num_threads=1), pa.large_list(pa.int64()))
        return first, second


@lru_cache(maxsize=1)
def _vocabularies(path_a: str, path_b: str) -> _Vocabularies:
    return _Vocabularies(path_a, path_b)


def _spelled(ids: np.ndarray, table: pa.Array) -> np.ndarray:
    """The bytes of tokens one after another."""
    taken = table.take(pa.array(ids))
    return np.frombuffer(taken.buffers()[2], np.uint8) if len(ids) and taken.buffers()[2] else np.zeros(0, np.uint8)


def _ends(lists: pa.ListArray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, text of each, where each ends in its text), flattened."""
    ids = lists.flatten().to_numpy()
    parent = pc.list_parent_indices(lists).to_numpy()
    total = np.cumsum(size[ids])
    counts = lists.value_lengths().to_numpy()
    begin = np.cumsum(counts) - counts
    before = np.concatenate([[0], total])[begin]  # a segmented sum: what came before the text is taken off
    return ids, parent, total - before[parent]


def _same_bytes(texts: list[bytes], sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Texts that each side spells exactly; a side is (all bytes, bytes of each text)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    good = np.logical_and.reduce([n == sizes for _, n in sides])
    for spelled, n in sides:
        stop = np.cumsum(n)
        if good.all() and spelled.tobytes() == b"".join(texts):
            continue
        for i in np.flatnonzero(good):
            good[i] = spelled[stop[i] - n[i]:stop[i]].tobytes() == texts[i]
    return good


def _joined(key_a: np.ndarray, key_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places on either side of all pairs of equal keys, in order."""
    a = pa.table({"key": key_a, "a": np.arange(len(key_a))})
    b = pa.table({"key": key_b, "b": np.arange(len(key_b))})
    found = a.join(b, "key", join_type="inner", use_threads=False)
    at_a, at_b = found.column("a").to_numpy(), found.column("b").to_numpy()
    if len(at_a) and not ((at_a[1:] > at_a[:-1]) | ((at_a[1:] == at_a[:-1]) & (at_b[1:] > at_b[:-1]))).all():
        order = np.lexsort((at_b, at_a))
        at_a, at_b = at_a[order], at_b[order]
    return at_a, at_b


def _group_of(key: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token, and whether it is its group's last; ``common`` marks
    tokens whose end both sides have."""
    last = common.copy()
    last[:-1] &= key[1:] != key[:-1]
    return np.cumsum(last) - last, last


def _written(v: _Vocabularies, a, b, group_a, group_b, last_a, last_b) -> pa.Array:
    """Digits and separator of every token, group by group, the first side before the second."""
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = 3 * a + last_a
    code[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 3 * b + 2 * last_b
    return v.digits.take(pa.array(code))


def align_slice(v: _Vocabularies, texts: list[str]) -> tuple[dict, pa.Table]:
    """Columns of each text, and the slice's pairs of linked ids with their counts.

    ``links`` of a text are places in the table of pairs."""
    n = len(texts)
    zeros = np.zeros(n, np.int64)
    none = {"n_a": zeros, "n_b": zeros, "n_groups": zeros, "n_links": zeros, "groups": [""] * n,
            "links": pa.array([[]] * n, pa.list_(pa.int32()))}
    no_pairs = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    present = [i for i, t in enumerate(texts) if t]
    if not present:
        return none, no_pairs
    lists = v.ids([texts[i] for i in present])
    raw = [b" " + texts[i].encode() for i in present]
    sides = []
    for ids, size, table in zip(lists, (v.size_a, v.size_b), (v.bytes_a, v.bytes_b)):
        flat, counts = ids.flatten().to_numpy(), ids.value_lengths().to_numpy()
        total = np.concatenate([[0], np.cumsum(size[flat])])
        stop = np.cumsum(counts)
        sides.append((_spelled(flat, table), total[stop] - total[stop - counts]))
    good = np.flatnonzero(_same_bytes(raw, sides))
    if not len(good):
        return none, no_pairs
    where = np.asarray(present)[good]
    if len(good) < len(present):
        lists = [x.take(pa.array(good)) for x in lists]
    (a, doc_a, end_a), (b, doc_b, end_b) = (_ends(x, size) for x, size in zip(lists, (v.size_a, v.size_b)))
    key_a, key_b = doc_a << 40 | end_a, doc_b << 40 | end_b
    at_a, at_b = _joined(key_a, key_b)
    common_a, common_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    common_a[at_a], common_b[at_b] = True, True
    (group_a, last_a), (group_b, last_b) = _group_of(key_a, common_a), _group_of(key_b, common_b)
    tokens = _written(v, a, b, group_a, group_b, last_a, last_b)
    n_a, n_b = (np.bincount(x, minlength=len(good)) for x in (doc_a, doc_b))
    offsets = np.frombuffer(tokens.buffers()[1], np.int64)
    stop = np.cumsum(n_a + n_b)
    written = tokens.buffers()[2].to_pybytes().decode("ascii")
    pair = pa.array(a[at_a] << 32 | b[at_b])
    pairs = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
    place = pc.index_in(pair, value_set=pairs.column("pair").combine_chunks())
    n_links = np.bincount(doc_a[at_a], minlength=len(good))

    def spread(values: np.ndarray) -> np.ndarray:
        out = zeros.copy()
        out[where] = values
        return out

    groups = [""] * n
    for i, x, y in zip(where.tolist(), offsets[stop - n_a - n_b].tolist(), offsets[stop].tolist()):
        groups[i] = written[x:y - 1]
    links = spread(n_links)
    return {"n_a": spread(n_a), "n_b": spread(n_b), "n_groups": spread(np.bincount(doc_a[last_a], minlength=len(good))),
            "n_links": links, "groups": groups,
            "links": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(links)]).astype(np.int32), place)}, pairs


def _align(path_a: str, path_b: str):
    def batch(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f], kind) if f in columns and not isinstance(columns[f], pa.Array) else columns.get(f, pa.nulls(n, kind))
             for f, kind in zip(_FIELDS, _KINDS)], names=_FIELDS)

    def run(batches):
        v = _vocabularies(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for rows in batches:
            text = rows.column(1).to_pylist()
            for begin, end in slices(map(len, text), SLICE):
                columns, pairs = align_slice(v, text[begin:end])
                yield batch(end - begin, {"slice": np.full(end - begin, number), "doc_id": rows.column(0).slice(begin, end - begin), **columns})
                if pairs.num_rows:
                    yield batch(pairs.num_rows, {
                        "slice": np.full(pairs.num_rows, number), "place": np.arange(pairs.num_rows, dtype=np.int32),
                        **{f: pairs.column(f).combine_chunks() for f in ("pair", "n")}})
                number += 1

    return run


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]


def _judge(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """n_best and count_sum of a slice's texts, from its pairs' counts in the corpus."""
    counts = counts.sort_by("place")
    of, best = counts.column("n").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
    links = texts.column("links").combine_chunks()
    flat, parent = links.flatten(), pc.list_parent_indices(links)
    per_link = pa.table({"parent": parent, "n": of[flat.to_numpy()], "best": best[flat.to_numpy()]})
    summed = per_link.group_by("parent", use_threads=False).aggregate([("n", "sum"), ("best", "sum")])
    out = np.zeros((2, texts.num_rows), np.int64)
    out[:, summed.column("parent").to_numpy()] = summed.column("best_sum").to_numpy(), summed.column("n_sum").to_numpy()
    return texts.select(_RESULT).append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1]))


def align(docs: DataFrame, path_a: str, path_b: str, describe: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum of every row.

    ``docs``: doc_id, text; other columns are not read, whatever their names. The first
    tokenizer (a byte-level BPE in ``tokenizers`` JSON) encodes a space and the text,
    the second (a SentencePiece model, which adds that space itself) the text. Ends that
    both have cut a text into groups, written ``a1,a2|b1;a3|b2,b3``. A link is a pair of
    tokens that end together; its count is how often the corpus links its two ids, and
    it is one of the best if no other id of the first vocabulary is linked more often
    with its second id. ``describe`` turns the column of groups into what is kept of it.

    Texts that are null or empty, and texts that either side does not spell exactly
    (U+2581 in a text reads as a space), have no tokens: zeros and empty groups. A null
    doc_id stays null; rows count as often as they occur. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    aligned = rows.mapInArrow(_align(path_a, path_b), _TOKENS)
    if describe:
        aligned = aligned.withColumn("groups", describe(F.col("groups")))
    aligned = store(aligned, "token-links")
    partial = aligned.filter("place is not null").select("slice", "place", "pair", "n")
    total = partial.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit(_LOW)))
    highest = total.groupBy("b").agg(F.max("n").alias("highest"))
    judged = store(total.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "token-pairs")
    asked = partial.select("slice", "place", "pair").join(judged, "pair").select(F.col("slice").alias("of"), "place", "n", "best")
    texts = aligned.filter("place is null").select("slice", *_RESULT, "links")
    kind = aligned.schema["groups"].dataType.simpleString()
    return texts.groupBy("slice").cogroup(asked.groupBy("of")).applyInArrow(
        _judge, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups {kind}, n_best long, count_sum long")
