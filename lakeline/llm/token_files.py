"""Token counts of documents in flat token files.

A flat file is nothing but identifiers one after another, each document closed by
an end-of-document identifier; there is no index. It is read as fixed blocks that
begin and end anywhere. Each block finds its separators with one vectorised
comparison; what a document has before the block is stitched on by a prefix scan
over the blocks' tails, in two levels so that no file is scanned by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.bpe import encoder
from lakeline.llm.tables import slices, store, texts

END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 65_536
BLOCKS_PER_SPAN = 1_024

_BLOCKS = "file int, block long, payload binary, doc_ids array<long>"


def _write(path: str, end: int, block: int, kind: str):
    def run(batches):
        model = encoder(path)
        task = TaskContext.get().partitionId()
        number, held, ids = 0, np.zeros(0, kind), []

        def row(tokens):
            nonlocal number, ids
            ended = int(np.count_nonzero(tokens == end))
            out = pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([number], pa.int64()), pa.array([tokens.tobytes()], pa.binary()),
                 pa.array([ids[:ended]], pa.list_(pa.int64()))], names=["file", "block", "payload", "doc_ids"])
            ids = ids[ended:]
            number += 1
            return out

        for batch in batches:
            names, text = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, text), 3_000_000):
                flat, n = model.encode(text[a:b])
                closed = np.insert(flat, np.cumsum(n), end)
                if len(closed) and closed.max() > np.iinfo(kind).max:
                    raise ValueError(f"identifier {closed.max()} does not fit {kind}")
                closed = closed.astype(kind)
                held = np.concatenate([held, closed])
                ids += names[a:b]
                full = len(held) // block * block
                for i in range(0, full, block):
                    yield row(held[i:i + block])
                held = held[full:]
        if len(held):
            yield row(held)

    return run


def flat_blocks(docs: DataFrame, tokenizer_path: str, end: int = END_OF_DOCUMENT, block: int = BLOCK_TOKENS) -> DataFrame:
    """file, block, payload, doc_ids: the documents as flat files of 16-bit
    identifiers, one file per task, in blocks; doc_ids names the documents that end
    in a block. A null text is an empty document. A vocabulary whose identifiers do not
    fit 16 bits raises."""
    return store(texts(docs).mapInArrow(_write(tokenizer_path, end, block, "<u2"), _BLOCKS), "token-files")


def _find(end: int, kind: str):
    def run(batches):
        for batch in batches:
            rows = []
            for payload in batch.column(2).to_pylist():
                tokens = np.frombuffer(payload or b"", kind)
                at = np.flatnonzero(tokens == end)
                tail = len(tokens) - 1 - int(at[-1]) if len(at) else len(tokens)
                rows.append((len(tokens), len(at) > 0, tail, at.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *(pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.int64(), pa.bool_(), pa.int64(), pa.binary())))],
                names=["file", "block", "doc_ids", "n", "has", "tail", "ends"])

    return run


def _counts(batches):
    for batch in batches:
        ids, files, starts, sizes = [], [], [], []
        for file, names, ends, begin, carry in zip(*(batch.column(c).to_pylist() for c in ("file", "doc_ids", "ends", "begin", "carry"))):
            at = np.frombuffer(ends, "<i8")
            before = np.concatenate([[-1 - carry], at[:-1]])
            ids += list(names or [])[:len(at)] + [None] * (len(at) - len(names or []))
            files.append(np.full(len(at), file, np.int32))
            starts.append(begin + before + 1)
            sizes.append(at - before - 1)
        join = lambda x, t: pa.array(np.concatenate(x).astype(t) if x else np.zeros(0, t))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), join(files, np.int32), join(starts, np.int64), join(sizes, np.int64)],
            names=["doc_id", "file", "start", "n_tokens"])


def count_tokens(blocks: DataFrame, end: int = END_OF_DOCUMENT, kind: str = "<u2") -> DataFrame:
    """doc_id, file, start, n_tokens of every document that ends in a flat file.

    ``blocks``: file, block (0, 1, ... in each file), payload, doc_ids. Payloads may
    have any length. ``start`` is the document's first token in its file;
    ``n_tokens`` leaves out the separator. Two separators in a row are a document of
    0 tokens; tokens after a file's last separator belong to no ended document and
    are not reported. A null payload is empty. Where doc_ids names fewer documents
    than end in a block, the others' doc_id is null. No blocks give no rows.
    """
    found = blocks.select("file", "block", "payload", "doc_ids").mapInArrow(
        _find(end, kind), "file int, block long, doc_ids array<long>, n long, has boolean, tail long, ends binary")
    found = store(found.withColumn("span", F.floor(F.col("block") / BLOCKS_PER_SPAN)), "token-files-ends")

    def scan(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        """carry: tails since the last separator before each row; open: no separator before it."""
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        summed = rows.withColumn("before", F.coalesce(F.sum("tail").over(w), F.lit(0))) \
            .withColumn("offset", F.coalesce(F.sum("n").over(w), F.lit(0)))
        return summed.withColumn("reset", F.max(F.when(F.col("has"), F.col("before"))).over(w)) \
            .withColumn("carry", F.col("before") - F.coalesce("reset", F.lit(0))).withColumn("open", F.col("reset").isNull())

    local = scan(found, ["file", "span"], "block")
    ends_of = local.groupBy("file", "span").agg(
        F.sum("n").alias("n"), F.max("has").alias("has"),
        (F.sum("tail") - F.coalesce(F.max(F.when(F.col("has"), F.col("before"))), F.lit(0))).alias("tail"))
    spans = scan(ends_of, ["file"], "span").select(
        "file", "span", F.col("carry").alias("span_carry"), F.col("offset").alias("span_offset"))
    stitched = local.filter("has").join(spans, ["file", "span"]).select(
        "file", "doc_ids", "ends", (F.col("offset") + F.col("span_offset")).alias("begin"),
        (F.col("carry") + F.when(F.col("open"), F.col("span_carry")).otherwise(F.lit(0))).alias("carry"))
    return stitched.mapInArrow(_counts, "doc_id long, file int, start long, n_tokens long")
