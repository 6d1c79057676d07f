"""Importance resampling: documents drawn to look like a target set.

Two hashed n-gram models, one of target texts and one of the whole corpus, give
every document the log ratio of its probability under either. The documents are
then sampled without replacement in proportion to that weight: Gumbel noise is
added to each log weight and the k largest sums are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm import words
from lakeline.llm.repeats import mix
from lakeline.llm.tables import slices, store

BUCKETS = 16_384  # of the hashed unigrams and bigrams
TARGET_SAMPLE = 20_000  # labelled target documents at most that the model is fitted on
FULL_WEIGHT = 200  # n-grams from which on a document's length no longer adds to its weight
KEEP_OF_TARGET = 0.998  # share of held-out target documents that the kept number must allow
SEED = 7
_BINS = 2_048


def features(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and each document's range of them.

    Tokens are runs of letters and digits, and runs of other visible characters."""
    data = np.frombuffer(b" ".join(docs) + b" ", np.uint8)
    kind = np.where(words.LETTERS[data], np.int8(1), np.where(words.BLANKS[data], np.int8(2), np.int8(0)))
    begins = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    ends = np.append(begins[1:], len(data))
    seen = kind[begins] > 0
    starts, ends = begins[seen], ends[seen]
    size = np.fromiter(map(len, docs), np.int64, len(docs)) + 1
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(size)]))
    h = words.hashes(data, starts, ends)
    one = (h % np.uint64(BUCKETS)).astype(np.int32)
    two = np.zeros(len(h), np.int32)
    two[:-1] = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) % np.uint64(BUCKETS) if len(h) > 1 else 0
    last = np.zeros(len(h), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True  # a document's last token begins no bigram
    keep = np.ones(2 * len(h), bool)
    keep[1::2] = ~last
    both = np.empty(2 * len(h), np.int32)
    both[0::2], both[1::2] = one, two
    total = np.concatenate([[0], np.cumsum(keep)])
    return both[keep], total[2 * bounds]


def _count(batches):
    held = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        docs = [t.encode() for t in batch.column(0).to_pylist()]
        target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for a, b in slices(map(len, docs), 4_000_000):
            f, cuts = features(docs[a:b])
            held[0] += np.bincount(f, minlength=BUCKETS)
            for i in np.flatnonzero(target[a:b]):
                held[1] += np.bincount(f[cuts[i]:cuts[i + 1]], minlength=BUCKETS)
    for kind in range(2):
        at = np.flatnonzero(held[kind])
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(held[kind][at])],
                names=["kind", "bucket", "n"])


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket's probability in the target and in the corpus."""

    ratio: np.ndarray

    def weights(self, texts: list[str | None]) -> np.ndarray:
        docs = [(t or "").encode() for t in texts]
        out = np.zeros(len(docs))
        for a, b in slices(map(len, docs), 4_000_000):
            f, cuts = features(docs[a:b])
            total = np.concatenate([[0.0], np.cumsum(self.ratio[f])])
            n = np.diff(cuts)
            out[a:b] = (total[cuts[1:]] - total[cuts[:-1]]) * np.minimum(1, FULL_WEIGHT / np.maximum(n, 1))
        return np.round(out, 6)

    def column(self, text):
        """The log weight of a text column (0 for null and empty texts)."""
        def weigh(batches):
            for t in batches:
                yield pd.Series(self.weights(t.tolist()))

        weigh.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(weigh, "double")(text)


def _lower():
    return F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _good(labels: DataFrame) -> DataFrame:
    """target_id of every document labelled as target."""
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("target_id")).distinct()


def _fitted(labels: DataFrame, sample: int) -> DataFrame:
    """target_id of every second one of up to ``sample`` documents labelled as target, by
    hash order. Bounded, so it may be broadcast."""
    picked = _good(labels).orderBy(F.xxhash64("target_id", F.lit(SEED)), "target_id").limit(sample)
    return picked.filter(F.pmod(F.xxhash64("target_id"), F.lit(2)) == 0)


def fit(docs: DataFrame, fitted: DataFrame) -> Model:
    """Corpus counts over all of ``docs``, target counts over those in ``fitted``."""
    chosen = F.broadcast(fitted)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lower().alias("text")) \
        .join(chosen, F.col("doc_id") == F.col("target_id"), "left") \
        .select("text", F.col("target_id").isNotNull().alias("target"))
    sums = marked.mapInArrow(_count, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, BUCKETS))
    for r in sums.collect():  # 2 * BUCKETS rows at most
        counts[r["kind"], r["bucket"]] = r["n"]
    if not counts[1].any():
        return Model(np.zeros(BUCKETS))  # nothing to resemble: all weigh the same
    p = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    return Model(np.log(p[1]) - np.log(p[0]))


def gumbel(doc_id: str = "doc_id", text: str = "text"):
    """Noise of a row, the same in every run: from its doc_id and text."""
    u = (F.pmod(F.xxhash64(doc_id, text, F.lit(SEED)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest ``key`` (minus infinity if there are no more than k), by
    narrowing a histogram; a bin's rows are collected once they are few."""
    total = keys.count()
    if k >= total:
        return float("-inf")
    if k <= 0:
        return float("inf")
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    above = 0  # rows over ``high``
    while low < high:
        inside = keys.filter(F.col("key").between(low, high))
        step = (high - low) / _BINS
        bin_ = F.least(F.floor((F.col("key") - low) / step), F.lit(_BINS - 1))
        bins = {r["bin"]: r for r in inside.groupBy(bin_.alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b]["n"] >= k:
                break
            above += bins[b]["n"]
        low, high = bins[b]["low"], bins[b]["high"]
        if bins[b]["n"] <= 10_000:
            rows = keys.filter(F.col("key").between(low, high)).select("key").collect()
            return sorted((r["key"] for r in rows), reverse=True)[k - above - 1]
    return high


def quantile(keys: DataFrame, share: float) -> float | None:
    """The exact quantile of ``key``, between two rows in proportion; None of no rows."""
    total = keys.count()
    if not total:
        return None
    place = share * (total - 1)
    below, above = int(np.floor(place)), int(np.ceil(place))
    low, high = (kth_largest(keys, total - i) if i else keys.agg(F.min("key")).first()[0] for i in (below, above))
    return low if below == above else (above - place) * low + (place - below) * high


@dataclass(frozen=True)
class Selection:
    model: Model
    cut: float
    scored: DataFrame  # doc_id, log_weight, key


def select(docs: DataFrame, labels: DataFrame, sample: int = TARGET_SAMPLE, keep: float = KEEP_OF_TARGET) -> Selection:
    fitted = store(_fitted(labels, sample), "importance-fitted")
    model = fit(docs, fitted)
    scored = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lower().alias("text"))
        .select("doc_id", "text", model.column(F.col("text")).alias("log_weight"))
        .select("doc_id", "log_weight", (F.col("log_weight") + gumbel()).alias("key")), "importance-scored")
    is_target = F.col("doc_id") == F.col("target_id")
    held = store(
        scored.join(F.broadcast(fitted), is_target, "left_anti").join(_good(labels), is_target, "left_semi")
        .select(F.col("log_weight").alias("key")), "importance-held-out")
    floor = quantile(held, 1 - keep)
    k = scored.count() if floor is None else scored.filter(F.col("log_weight") >= floor).count()
    return Selection(model, kth_largest(scored, k), scored)


def resample(docs: DataFrame, labels: DataFrame, sample: int = TARGET_SAMPLE, keep: float = KEEP_OF_TARGET) -> DataFrame:
    """doc_id, log_weight, key, kept of every document.

    ``docs``: doc_id, text; ``labels``: doc_id, quality; other columns are not read.
    The target model is fitted on one half of up to ``sample`` documents labelled
    quality 1 (chosen by hash), the corpus model on all documents. k is the number
    of documents that weigh at least what a share ``keep`` of all others labelled so does;
    the k largest keys (log weight plus Gumbel noise) are kept, ties at the last one
    included. Of a text of more than ``FULL_WEIGHT`` n-grams the log ratio is scaled to
    that many, so that a long text's weight tells how it is written, not how long it is;
    shorter texts have the plain sum. Null and empty texts weigh 0. Without target documents everything
    is kept. Rows that repeat get equal results; a null doc_id stays null.
    """
    chosen = select(docs, labels, sample, keep)
    return chosen.scored.withColumn("kept", F.col("key") >= F.lit(chosen.cut))


def keep_target_like(docs: DataFrame, labels: DataFrame, sample: int = TARGET_SAMPLE, keep: float = KEEP_OF_TARGET) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` keeps, all columns as they were.

    Weights are computed again where the documents are read, so that no text is
    shuffled to meet a decision."""
    chosen = select(docs, labels, sample, keep)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), _lower().alias("text"))
    weighed = rows.withColumn("weight", chosen.model.column(F.col("text")))
    return weighed.filter(F.col("weight") + gumbel() >= F.lit(chosen.cut)).select("row.*")
