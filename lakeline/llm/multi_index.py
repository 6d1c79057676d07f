"""Nearest neighbours through multi-index hashing of learned rotated binary codes.

Codes: vectors are centred, rotated so that their signs lose least (iterative
quantisation, one learned rotation for each run of bits) and kept as signs. A code
is cut into 16-bit substrings, each with an index of its own. If two codes differ
in at most r bits, some substring differs in at most r / substrings of them; so the
buckets within that distance hold every code in the radius. Those codes are
checked in full and reranked by their original vectors.

The index is built in blocks of rows, the queries go to every block in blocks of
their own, and each pair of blocks returns its nearest per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.tables import shuffle_partitions, store
from lakeline.llm.vectors import matrix, usable

BITS = 128
PART = 16  # bits of a substring
SAMPLE = 8_192  # vectors at most that the codes are learned from
TARGET = 0.97  # share of the sample's true neighbours that the radius must reach
BLOCK = 65_536  # rows of an index block at most
QUERY_BLOCK = 16_384
LEAST_BLOCK = 64  # rows below which blocks are not made smaller to spread them
_ONES = np.bitwise_count(np.arange(1 << PART, dtype=np.uint16)).astype(np.uint8)


@dataclass(frozen=True)
class Codes:
    mean: np.ndarray
    rotations: np.ndarray  # dimensions x BITS
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = (vectors - self.mean) @ self.rotations > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def learn(vectors: np.ndarray, neighbours: int, seed: int = 8) -> Codes:
    """Mean, rotations and radius from a sample."""
    rng = np.random.default_rng(seed)
    d = vectors.shape[1]
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    parts = []
    while sum(p.shape[1] for p in parts) < BITS:
        rotation, _ = np.linalg.qr(rng.standard_normal((d, d)))
        for _ in range(10):  # alternate between the signs and the rotation that fits them best
            signs = np.sign(centred @ rotation)
            u, _, v = np.linalg.svd(centred.T @ signs, full_matrices=False)
            rotation = u @ v
        parts.append(rotation)
    codes = Codes(mean, np.hstack(parts)[:, :BITS], 0)
    all_codes = codes.of(vectors).view(np.uint64)
    asked = np.arange(len(vectors))[:: max(1, len(vectors) // 256)]
    far = []
    for q in asked:
        score = vectors @ vectors[q]
        score[q] = -np.inf
        k = min(neighbours, len(vectors) - 1)
        if k > 0:
            near = np.argpartition(-score, k - 1)[:k]
            far.append(np.bitwise_count(all_codes[near] ^ all_codes[q]).sum(axis=1))
    radius = int(np.quantile(np.concatenate(far), TARGET)) if far else BITS
    return Codes(mean, codes.rotations, radius)


class Index:
    """One bucket list per substring position over the codes of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.view(np.uint64)
        self.parts = codes.shape[1]
        self.order, self.values, self.cuts = [], [], []
        for j in range(self.parts):
            order = np.argsort(codes[:, j], kind="stable")
            s = codes[order, j]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            self.order.append(order)
            self.values.append(s[first])
            self.cuts.append(np.append(first, len(s)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs in at most ``radius`` bits."""
        near = np.zeros(len(self.codes), bool)
        each, spare = divmod(radius, self.parts)
        for j in range(self.parts):
            # of all substrings, only the first spare + 1 need the larger distance
            most = each if j <= spare else each - 1
            if most < 0:
                continue
            hit = np.flatnonzero(_ONES[self.values[j] ^ code[j]] <= most)
            size = self.cuts[j][hit + 1] - self.cuts[j][hit]
            at = np.arange(int(size.sum())) + np.repeat(self.cuts[j][hit] - (np.cumsum(size) - size), size)
            near[self.order[j][at]] = True
        rows = np.flatnonzero(near)
        far = np.bitwise_count(self.codes[rows] ^ code.view(np.uint64)).sum(axis=1)
        return rows[far <= radius]


def _search(codes: Codes, neighbours: int):
    """The nearest of one index block for each query of a query block, packed."""
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        vec_ids, scores = [], []
        if rows.num_rows and asked.num_rows:
            base, queries = matrix(rows.column("vec")), matrix(asked.column("vec"))
            ids = [np.array(x, np.int64) for x in rows.column("ids").to_pylist()]
            index, code = Index(codes.of(base)), codes.of(queries)
            for i in range(len(queries)):
                radius = codes.radius
                hit = index.within(code[i], radius)
                while len(hit) <= neighbours and len(hit) < len(base):  # a block with few codes that near
                    radius = min(BITS, radius + PART // 2)
                    hit = index.within(code[i], radius)
                score = (base[hit] * queries[i]).sum(axis=1)
                if len(hit) > neighbours + 1:
                    last = np.partition(score, len(hit) - neighbours - 1)[len(hit) - neighbours - 1]
                    hit, score = hit[score >= last], score[score >= last]
                own = [ids[j] for j in hit]
                vec, value = np.concatenate(own), np.repeat(score, [len(x) for x in own])
                best = np.lexsort((vec, -value))[:neighbours + 1]
                vec_ids.append(vec[best])
                scores.append(value[best])
        taken = asked.select(["first", "same"]).slice(0, len(vec_ids))
        return taken.append_column("vec_ids", pa.array(vec_ids, pa.list_(pa.int64()))) \
            .append_column("scores", pa.array(scores, pa.list_(pa.float64())))

    return lambda key, rows, asked: run(rows, asked)


def _merge(neighbours: int):
    """The nearest of all blocks for one query: a short list from each."""
    def run(table: pa.Table) -> pa.Table:
        vec = table.column("vec_ids").combine_chunks().flatten().to_numpy()
        value = table.column("scores").combine_chunks().flatten().to_numpy()
        best = np.lexsort((vec, -value))[:neighbours + 1]
        return table.select(["first", "same"]).slice(0, 1) \
            .append_column("vec_ids", pa.array([vec[best]], pa.list_(pa.int64()))) \
            .append_column("scores", pa.array([value[best]], pa.list_(pa.float64())))

    return run


def nearest(embeddings: DataFrame, every: int = 20, neighbours: int = 20, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each query.

    ``embeddings``: vec_id, embedding; other columns are not read. Queries are the
    vectors whose vec_id is divisible by ``every``, candidates all others. Nearness
    is the inner product of the original vectors in double precision, ties go to
    the smaller vec_id. Unusable vectors (see :func:`vectors.usable`) take no part.
    Rows that repeat a vec_id with one vector count once; with several vectors each
    is a candidate and a query of its own. Equal vectors are searched once, and of
    a group of equal ones only the ``neighbours`` + 1 smallest vec_ids can be among
    the nearest. No vectors give no rows. The codes are learned from up to
    ``sample`` vectors chosen by hash; every vector is indexed.
    """
    spark = embeddings.sparkSession
    rows = store(usable(embeddings).distinct().withColumn("same", F.xxhash64("vec")), "multi-index-vectors")
    n = rows.select("vec").distinct().count()
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # one row per different vector, under its smallest vec_id, with its smallest ids
    smallest = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    kept = rows.withColumn("place", smallest).filter(F.col("place") <= neighbours + 1)
    asks = rows.groupBy("vec").agg(F.max(F.col("vec_id") % every == 0).alias("asked"))
    different = store(
        kept.groupBy("vec", "same").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("first", F.col("ids")[0]).join(asks, "vec"), "multi-index-different")
    picked = different.orderBy(F.xxhash64("vec"), "first").limit(sample).select("vec").toArrow()
    codes = learn(matrix(picked.column("vec")), neighbours)
    blocks = max(-(-n // BLOCK), min(shuffle_partitions(spark), -(-n // LEAST_BLOCK)))
    q_blocks = -(-n // (every * QUERY_BLOCK))
    spot = F.xxhash64("vec", "first")
    index = different.select(
        F.pmod(spot, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("part"), "ids", "vec")
    asked = different.filter("asked").select(
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(spot, F.lit(q_blocks)).cast("int").alias("part"), "first", "same", "vec")
    found = store(index.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        _search(codes, neighbours), "first long, same long, vec_ids array<long>, scores array<double>"), "multi-index-found")
    lists = found.groupBy("first", "same").applyInArrow(
        _merge(neighbours), "first long, same long, vec_ids array<long>, scores array<double>") \
        .select("first", "same", F.arrays_zip("vec_ids", "scores").alias("list"))
    groups = rows.join(different.filter("asked").select("vec", "first"), "vec") \
        .filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "first", "same")
    own = F.slice(F.filter("list", lambda x: x["vec_ids"] != F.col("query_id")), 1, neighbours)
    return groups.join(lists, ["first", "same"]).select("query_id", F.posexplode(own).alias("rank", "x")) \
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_ids").alias("vec_id"), F.col("x.scores").alias("score"))
