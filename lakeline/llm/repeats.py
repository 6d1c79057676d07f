"""Windows of documents that occur more than once, found without comparing documents.

A document is a sequence of units (bytes, or hashed words); a window is ``width``
of them in a row. Every window has an anchor, the gram of ``gram`` units with the
least hash among those it holds, leftmost on ties. Equal windows have equal anchors,
so a window whose anchor occurs once in the corpus occurs once itself.

1. ``shared_anchors``: every task sends the anchors it met, in one packed row per
   bucket of anchors, and is told which of them others met as well.
2. ``stretches``: the stretches of windows around shared anchors, cut from the
   documents. All windows of a stretch have one anchor at one place.
3. ``verdicts``: equal stretches are merged first, so that thousands of copies
   weigh as one; the rest meets by anchor in groups, where an index of the
   caller's choice judges every window. An anchor with very many different
   stretches around it (the edge of a passage that many documents share) is not
   gathered in one group: its windows meet by their own content.

Anchors are 44-bit hashes: a clash only makes a stretch a candidate in vain. The
judgement compares whole windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.tables import discard, groups_for, slices, store

_BITS = 20
_BLOCK = 1 << _BITS
_KEY_BITS = 64 - _BITS
NO_ID = -(1 << 63)  # stands for a null doc_id
HOMES = 1_024  # the answers of a bucket are packed in so many rows at most, by hash of the document
GATHERED = 4_000_000  # anchors that a task holds while it puts a home's answers in order
COMMON_IN_SLICE = 32  # documents of one slice; such an anchor is announced once
DISTINCT_PER_ANCHOR = 2_000  # different stretches of an anchor that one group takes
SLICE = 4_000_000  # bytes of text handled at a time
ANCHORS_PER_BUCKET = 400_000
STRETCH_BYTES_PER_GROUP = 1_000_000

Units = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _grams(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` units in a row, from hashes of 1, 2, 4, ... in a row."""
    level, span, out, held = units, 1, None, 0
    while span <= gram:
        if gram & span:  # the next units of the gram are ``span`` many
            n = len(units) - held - span + 1
            part = level[held:held + n]
            out = part if out is None else out[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * span) + part
            held += span
        if 2 * span <= gram:
            level = level[:-span] * np.uint64(0x9E3779B97F4A7C15 + 2 * span) + level[span:]
            level ^= level >> np.uint64(31)
        span *= 2
    return mix(out)


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` values in a row."""
    n, held, cur = len(x) - span + 1, 1, x
    while 2 * held <= span:
        cur = np.minimum(cur[:-held], cur[held:])
        held *= 2
    return np.minimum(cur[:n], cur[span - held:span - held + n])


def runs(units: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """First window, number of windows and anchor of every stretch with one anchor."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    out = []
    step = _BLOCK - width
    for a in range(0, max(0, len(units) - width + 1), step):
        h = _grams(units[a:a + step + width - 1], gram)
        h >>= np.uint64(_BITS)
        h <<= np.uint64(_BITS)
        h |= np.arange(len(h), dtype=np.uint64)
        least = _least(h, width - gram + 1)
        valid = np.flatnonzero(owner[a:a + len(least)] == owner[a + width - 1:a + width - 1 + len(least)])
        if not len(valid):
            continue
        least = least[valid]
        new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        out.append((valid[new] + a, np.diff(np.append(new, len(valid))), least[new] >> np.uint64(_BITS)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _binaries(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``data`` between consecutive ``cuts`` (in items)."""
    raw = np.ascontiguousarray(data)
    offsets = (np.asarray(cuts, np.int64) * raw.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _joined(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column as one array, and the items of each."""
    values = [v or b"" for v in column.to_pylist()]
    return np.frombuffer(b"".join(values), dtype), np.array([len(v) for v in values], np.int64) // np.dtype(dtype).itemsize


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls and the cuts between its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[cuts[0]:cuts[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, cuts - cuts[0]


_ASKED = "bucket int, doc_id long, low binary, high binary, owners binary"
_TOLD = "home int, keys binary, counts binary, low binary, high binary"


def _ask(units_of: Units, width: int, gram: int, buckets: int):
    def rows(ids, texts):
        units, bounds = units_of(texts)
        first, _, anchor = runs(units, bounds, width, gram)
        owner = np.searchsorted(bounds, first, "right") - 1
        order = np.argsort(anchor, kind="stable")  # owners stay in order
        anchor, owner = anchor[order], owner[order]
        again = np.zeros(len(anchor), bool)  # the same anchor of the same document: two say enough
        again[2:] = (anchor[2:] == anchor[:-2]) & (owner[2:] == owner[:-2])
        anchor, owner = anchor[~again], owner[~again]
        if not len(anchor):
            return
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(anchor)))
        common = np.repeat(size >= COMMON_IN_SLICE, size)
        mark = common.astype(np.uint16) << np.uint16(15)
        sent = ~common | new
        yield _packed(anchor[sent], mark[sent], ids[owner[sent]], buckets)
        if common.any():  # known to be shared: the owners hear it from here
            a, o = anchor[common], owner[common]
            order = np.argsort(o, kind="stable")
            a, o = a[order], o[order]
            cuts = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1], [True]]))
            n = len(cuts) - 1
            who = ids[o[cuts[:-1]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array((who % buckets).astype(np.int32)), pa.array(who), _binaries((a & np.uint64(0xFFFFFFFF)).astype("<u4"), cuts),
                 _binaries((a >> np.uint64(32)).astype("<u2"), cuts), pa.nulls(n, pa.binary())],
                names=["bucket", "doc_id", "low", "high", "owners"])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in slices(map(len, texts), SLICE):
                yield from rows(ids[a:b], texts[a:b])

    return run


def _packed(anchor, mark, owners, buckets):
    bucket = ((anchor >> np.uint64(4)) * np.uint64(buckets) >> np.uint64(_KEY_BITS - 4)).astype(np.int32)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    n = len(cuts) - 1
    span = int(owners.max()) - int(owners.min())
    base = int(owners.min()) if span < 1 << 32 else 0
    owners = (owners - base).astype("<u4") if span < 1 << 32 else owners
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]]), pa.array(np.full(n, base)),
         _binaries((anchor & np.uint64(0xFFFFFFFF)).astype("<u4"), cuts),
         _binaries((anchor >> np.uint64(32)).astype("<u2") | mark, cuts), _binaries(owners, cuts)],
        names=["bucket", "doc_id", "low", "high", "owners"])


def _tell(table: pa.Table) -> pa.Table:
    """One bucket: which anchors several askers sent, packed for each home of documents."""
    asked = table.filter(table.column("owners").is_valid())
    passed = table.filter(table.column("owners").is_null())
    who, what = [], []
    if asked.num_rows:
        low, n = _joined(asked.column("low"), "<u4")
        high, _ = _joined(asked.column("high"), "<u2")
        owners = []
        for base, raw, k in zip(asked.column("doc_id").to_pylist(), asked.column("owners").to_pylist(), n.tolist()):
            owners.append(np.frombuffer(raw, "<u4" if len(raw) == 4 * k else "<i8").astype(np.int64) + base)
        owner = np.concatenate(owners)
        told = high >> np.uint16(15) > 0
        anchor = (high & np.uint16(0x7FFF)).astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)
        order = np.argsort(anchor)
        anchor, owner, told = anchor[order], owner[order], told[order]
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        size = np.diff(np.append(starts, len(anchor)))
        shared = (size > 1) | (np.add.reduceat(told.astype(np.int32), starts) > 0)
        keep = np.repeat(shared, size) & ~told
        who.append(owner[keep])
        what.append(anchor[keep])
    if passed.num_rows:
        low, n = _joined(passed.column("low"), "<u4")
        high, _ = _joined(passed.column("high"), "<u2")
        who.append(np.repeat(passed.column("doc_id").to_numpy(), n))
        what.append(high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64))
    owner = np.concatenate(who) if who else np.zeros(0, np.int64)
    anchor = np.concatenate(what) if what else np.zeros(0, np.uint64)
    home = (mix(owner.astype(np.uint64)) % np.uint64(HOMES)).astype(np.int32)
    order = np.lexsort((owner, home))
    owner, anchor, home = owner[order], anchor[order], home[order]
    first = np.flatnonzero(_changes(home) | _changes(owner))  # where the answer of a document begins
    cuts = np.append(np.flatnonzero(_changes(home)), len(home))
    docs = np.searchsorted(first, cuts)
    return pa.table({
        "home": pa.array(home[cuts[:-1]]), "keys": _binaries(owner[first], docs),
        "counts": _binaries(np.diff(np.append(first, len(owner))).astype("<u4"), docs),
        "low": _binaries((anchor & np.uint64(0xFFFFFFFF)).astype("<u4"), cuts),
        "high": _binaries((anchor >> np.uint64(32)).astype("<u2"), cuts)})


def _changes(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _by_document(batches):
    """Answers of many buckets as one row per document, at most ``GATHERED`` anchors at a time."""
    held, count = [], 0

    def gathered():
        key, n, anchor = (np.concatenate(x) for x in zip(*held))
        owner = np.repeat(key, n)
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        cuts = np.append(np.flatnonzero(_changes(owner)), len(owner))
        return pa.RecordBatch.from_arrays([pa.array(owner[cuts[:-1]]), _binaries(anchor[order], cuts)], names=["key", "anchors"])

    for batch in batches:
        for keys, counts, low, high in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
            anchor = np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32) | np.frombuffer(low, "<u4").astype(np.uint64)
            held.append((np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<u4"), anchor))
            count += len(anchor)
            if count >= GATHERED:
                yield gathered()
                held, count = [], 0
    if held:
        yield gathered()


def key_of():
    """What a document is known by while anchors are exchanged: its doc_id, without one its text's hash."""
    return F.when(F.col("at") == NO_ID, F.col("same")).otherwise(F.col("at")).alias("key")


def with_key(docs: DataFrame) -> DataFrame:
    """``at``: doc_id with a number for null; ``same``: tells rows of one doc_id apart by text."""
    key = F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), F.xxhash64("text").alias("same")
    return docs.select("doc_id", "text", *key, *docs.columns[2:])


def same_texts(docs: DataFrame) -> DataFrame:
    """at, same, size, first, rows of every document: the least document with its text and how many rows have it.

    Equal texts repeat all their windows, so one of them stands for all in what follows."""
    key = [F.xxhash64("text").alias("same"), F.xxhash64(F.lit(1), "text").alias("other"), F.octet_length("text").alias("size")]
    rows = store(docs.select("at", *key), "repeats-texts")
    names = ["same", "other", "size"]
    groups = rows.groupBy(*names).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    known = store(rows.join(groups, names).select("at", "same", "size", "first", "rows"), "repeats-same-texts")
    discard(rows)
    return known


def shared_anchors(docs: DataFrame, units_of: Units, width: int, gram: int, amount: int) -> DataFrame:
    """key, anchors: of each document the anchors that occur elsewhere as well, in one row or several.

    ``amount``: bytes of text in all; it sets the number of buckets. Both ways are packed:
    questions per slice of text and bucket, answers per bucket and home, a hash class of
    documents. So what a bucket sends does not depend on how many documents there are.
    """
    spark = docs.sparkSession
    buckets = groups_for(spark, amount // 10, ANCHORS_PER_BUCKET)
    asked = docs.select(key_of(), "text").mapInArrow(_ask(units_of, width, gram, buckets), _ASKED)
    told = asked.groupBy("bucket").applyInArrow(_tell, _TOLD)
    return store(told.repartition("home").mapInArrow(_by_document, "key long, anchors binary"), "repeats-anchors")


_STRETCH = "at long, same long, start long, windows int, anchor long, stretch binary"


def _cut(units_of: Units, width: int, gram: int, raw_of):
    def run(batches):
        for batch in batches:
            at, same = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            lists = batch.column(3).to_pylist()
            for a, b in slices(map(len, texts), SLICE):
                units, bounds = units_of(texts[a:b])
                first, count, anchor = runs(units, bounds, width, gram)
                wanted = np.frombuffer(b"".join(x for part in lists[a:b] for x in part), np.uint64)
                hit = np.isin(anchor, wanted)
                first, count, anchor = first[hit], count[hit], anchor[hit]
                if not len(first):
                    continue
                owner = np.searchsorted(bounds, first, "right") - 1
                raw = raw_of(texts[a:b], units)
                span = count + width - 1
                cuts = np.concatenate([[0], np.cumsum(span)])
                index = np.repeat((first - cuts[:-1]).astype(np.int32), span)  # a slice or document is under 2 GB
                index += np.arange(cuts[-1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[a:b][owner]), pa.array(same[a:b][owner]), pa.array(first - bounds[owner]),
                     pa.array(count.astype(np.int32)), pa.array(anchor.astype(np.int64)), _binaries(raw[index], cuts)],
                    names=["at", "same", "start", "windows", "anchor", "stretch"])

    return run


def stretches(docs: DataFrame, texts: DataFrame, anchors: DataFrame, units_of: Units, width: int, gram: int, raw_of) -> DataFrame:
    """at, same, start, windows, anchor, stretch of every stretch with a shared anchor, from
    documents that stand for their text (``anchors`` is used up).

    ``raw_of``: the items (bytes, or hashes) that a stretch is written with.
    """
    standing = texts.filter(F.col("at") == F.col("first")).select(key_of()).distinct()
    by_doc = anchors.groupBy("key").agg(F.collect_list("anchors").alias("anchors")).join(standing, "key", "left_semi")
    cut = docs.select(key_of(), "at", "same", "text").join(by_doc, "key").select("at", "same", "text", "anchors").mapInArrow(
        _cut(units_of, width, gram, raw_of), _STRETCH)
    found = store(cut, "repeats-stretches")
    discard(anchors)
    return found



def _windows_of(width: int, item: int):
    """The windows of a stretch, each as a stretch of its own under its content's hash."""
    def run(batches):
        for batch in batches:
            at, window, content = [], [], []
            for i, s in enumerate(batch.column(2).to_pylist()):
                n = len(s) // item - width + 1
                at.extend([i] * n)
                window.extend(range(n))
                content.extend(s[j * item:(j + width) * item] for j in range(n))
            cols = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [cols.column(0), cols.column(1), pa.array(window, pa.int32()), pa.array(content, pa.binary()),
                 cols.column(3), cols.column(4), cols.column(5)],
                names=["whole_anchor", "whole", "window", "stretch", "times", "least", "most"])

    return run


@dataclass(frozen=True)
class Judge:
    """What makes a window repeat.

    ``alone(times, least, most)``: for stretches that are the only one of their
    anchor, the verdict on all windows and whether one is needed. ``compare(bytes,
    cuts, times, least, most)``: a verdict for each window of several stretches, one
    stretch after another (cuts in units), and which stretches need one."""

    alone: Callable
    compare: Callable


def verdicts(found: DataFrame, judge: Judge, width: int, item: int, none: np.generic) -> DataFrame:
    """anchor, mark, value, verdict of every stretch in which some window repeats.

    ``mark`` is :func:`mark_of` a stretch. ``value`` is the verdict of all windows, or
    null where they differ and ``verdict`` lists them; a window without a verdict
    counts as ``none``. ``item``: bytes of a unit.
    """
    kind = none.dtype
    merged = store(
        found.groupBy("anchor", "stretch").agg(F.count("*").alias("times"), F.min("at").alias("least"), F.max("at").alias("most")),
        "repeats-merged")
    busy = merged.groupBy("anchor").count().filter(F.col("count") > DISTINCT_PER_ANCHOR).select("anchor")
    size = merged.agg(F.sum(F.octet_length("stretch")).alias("n")).first()["n"] or 0
    groups = groups_for(merged.sparkSession, size, STRETCH_BYTES_PER_GROUP)

    def judged(table: pa.Table) -> pa.Table:
        """The only stretch of its anchor has windows that nothing else has; the others are indexed."""
        times, least, most = (table.column(c).to_numpy() for c in ("times", "least", "most"))
        _, which, size = np.unique(table.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
        only = size[which] == 1
        value, needed = judge.alone(times, least, most)
        kept = np.flatnonzero(only & needed)
        taken = table.select(["anchor", "mark"]).take(pa.array(kept)) \
            .append_column("value", pa.array(value[kept].astype(np.int64))).append_column("verdict", pa.nulls(len(kept), pa.binary()))
        several = np.flatnonzero(~only)
        if not len(several):
            return taken
        table = table.take(pa.array(several)).combine_chunks()
        raw, cuts = _spans(table.column("stretch"))
        each, needed = judge.compare(raw, cuts // item, times[several], least[several], most[several])
        edges = np.concatenate([[0], np.cumsum(np.diff(cuts // item) - width + 1)])
        return pa.concat_tables([taken, packed(table, each, edges, np.flatnonzero(needed))])

    def packed(table: pa.Table, each: np.ndarray, edges: np.ndarray, kept: np.ndarray) -> pa.Table:
        low = np.minimum.reduceat(each, edges[:-1]) if len(each) else each
        high = np.maximum.reduceat(each, edges[:-1]) if len(each) else each
        varied = low[kept] != high[kept]
        lists = [each[edges[i]:edges[i + 1]].tobytes() if v else None for i, v in zip(kept.tolist(), varied.tolist())]
        return table.select(["anchor", "mark"]).take(pa.array(kept)) \
            .append_column("value", pa.array(low[kept].astype(np.int64), mask=varied)) \
            .append_column("verdict", pa.array(lists, pa.binary()))

    def by_group(df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(groups))).withColumn("mark", mark_of()) \
            .select("shard", "anchor", "mark", "stretch", "times", "least", "most") \
            .groupBy("shard").applyInArrow(judged, "anchor long, mark long, value long, verdict binary")

    plain = by_group(merged.join(busy, "anchor", "left_anti"))
    if not busy.take(1):
        done = store(plain, "repeats-verdicts")
        discard(merged)
        return done
    each = store(
        merged.join(busy, "anchor", "left_semi").select("anchor", mark_of(), "stretch", "times", "least", "most")
        .mapInArrow(_windows_of(width, item),
                    "whole_anchor long, whole long, window int, stretch binary, times long, least long, most long"),
        "repeats-windows")
    alone = each.groupBy("stretch").agg(F.sum("times").alias("times"), F.min("least").alias("least"), F.max("most").alias("most")) \
        .filter(F.col("times") > 1).withColumn("anchor", F.xxhash64("stretch"))
    seen = store(by_group(alone), "repeats-window-verdicts")
    again = each.withColumn("anchor", F.xxhash64("stretch")) \
        .select("whole_anchor", "whole", "window", "anchor", mark_of()).join(seen, ["anchor", "mark"]) \
        .groupBy("whole_anchor", "whole").agg(F.collect_list(F.struct("window", "value")).alias("parts"))

    def assembled(batches):
        for batch in batches:
            out = []
            for parts in batch.column(2).to_pylist():
                room = np.full(max(p["window"] for p in parts) + 1, none, kind)
                for p in parts:
                    room[p["window"]] = p["value"]
                out.append(room.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.nulls(len(out), pa.int64()), pa.array(out, pa.binary())],
                names=["anchor", "mark", "value", "verdict"])

    judged_again = again.mapInArrow(assembled, "anchor long, mark long, value long, verdict binary")
    done = store(plain.unionByName(judged_again), "repeats-verdicts")
    discard(merged, each, seen)
    return done


def mark_of():
    """64 bits from the content of a stretch; together with its anchor they stand for it."""
    return F.xxhash64("stretch", "anchor").alias("mark")


def marks(found: DataFrame, judged: DataFrame, matters=None) -> DataFrame:
    """at, same, hits: of each document the stretches with a verdict (both inputs are used up).

    ``matters``: condition on at and value; other verdicts for a whole stretch are dropped."""
    hits = found.select("at", "same", "start", "windows", "anchor", mark_of()).join(judged, ["anchor", "mark"])
    if matters is not None:
        hits = hits.filter(F.col("value").isNull() | matters)
    by_doc = store(
        hits.groupBy("at", "same").agg(F.collect_list(F.struct("start", "windows", "value", "verdict")).alias("hits")),
        "repeats-hits")
    discard(found, judged)
    return by_doc


def hit_windows(hits: pa.Array, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window and verdict of all windows in the hits of a batch, and each row's range of them."""
    counts = np.asarray(hits.value_lengths().fill_null(0))
    flat = hits.flatten()
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(len(hits) + 1, np.int64)
    start, windows, value, verdict = flat.flatten()
    start = start.to_numpy(zero_copy_only=False).astype(np.int64)
    raw, cuts = _spans(verdict.fill_null(b""))
    listed = np.diff(cuts) // np.dtype(kind).itemsize
    same = np.asarray(value.is_valid())
    n = np.where(same, windows.to_numpy(zero_copy_only=False), listed)
    edges = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(edges[-1]) + np.repeat(start - edges[:-1], n)
    each = np.repeat(value.fill_null(0).to_numpy(zero_copy_only=False).astype(kind), n)
    each[np.repeat(~same, n)] = np.frombuffer(raw.tobytes(), kind)
    rows = np.concatenate([[0], np.cumsum(counts)])
    return at, each, edges[rows]
