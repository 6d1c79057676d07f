"""Near-duplicate vectors by p-stable hashing, exact cosines and components.

A table hashes a normalised vector by quantised Gaussian projections: several
floor((a.x + b) / w) together are a bucket. Vectors with a cosine over the
threshold are near in Euclidean distance too and meet in one of the tables with
the stated probability; the number of projections follows the number of vectors,
so that strangers seldom meet, and the number of tables follows from that. Pairs
that meet are checked exactly, and each only in the first table where it meets, so
links are counted where they are found and never listed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.components import components
from lakeline.llm.tables import groups_for, store
from lakeline.llm.vectors import matrix, usable

WIDTH = 2.0
RECALL = 0.995  # of a pair exactly at the threshold
BLOCK = 1_024  # rows of a bucket that one task compares with as many others
ROWS_PER_GROUP = 20_000
_PAIRS = 65_536


def meet(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection puts two vectors together."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def layout(n: int, threshold: float) -> tuple[int, int]:
    """Projections a table and tables for ``n`` vectors: strangers (orthogonal ones)
    meet 1/32 others in a table, pairs at the threshold meet with :data:`RECALL`."""
    near, far = meet(math.sqrt(2 - 2 * threshold)), meet(math.sqrt(2))
    projections = max(4, math.ceil(math.log(32 * max(n, 1)) / -math.log(far)))
    return projections, math.ceil(math.log(1 - RECALL) / math.log1p(-near ** projections))


def _normal(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, lest squares overflow or vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hash(projections: int, tables: int, seed: int = 10):
    def run(batches):
        for batch in batches:
            x = _normal(matrix(batch.column(1)))
            if not len(x):
                continue
            rng = np.random.default_rng(seed)
            a = rng.standard_normal((x.shape[1], projections * tables))
            b = rng.random(projections * tables) * WIDTH
            cell = np.floor((x @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(x), tables, projections)
            scale = rng.integers(1, 1 << 63, projections, dtype=np.uint64) | np.uint64(1)
            h = (cell * scale).sum(axis=2, dtype=np.uint64)
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(32))).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([r.tobytes() for r in h], pa.binary()), pa.array(list(h), pa.list_(pa.int64()))],
                names=["rep", "vec", "times", "codes", "buckets"])

    return run


def _compare(threshold: float):
    """One group of bucket blocks: links per vector and a tree of them.

    Rows: table, bucket, lo, hi (the two blocks compared), side (which of them the
    row is in), rep, vec, times, codes."""
    def run(table: pa.Table) -> pa.Table:
        rep, times = table.column("rep").to_numpy(), table.column("times").to_numpy()
        x = _normal(matrix(table.column("vec")))
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), "<i8").reshape(len(x), -1)
        keys = [table.column(c).to_numpy() for c in ("side", "hi", "lo", "bucket", "tab")]
        order = np.lexsort((rep, *keys))
        rep, times, x, codes = rep[order], times[order], x[order], codes[order]
        side, hi, lo, bucket, tab = (k[order] for k in keys)
        new = np.ones(len(rep) + 1, bool)
        new[1:-1] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (bucket[1:] != bucket[:-1]) | (tab[1:] != tab[:-1])
        cuts = np.flatnonzero(new)
        links, edges = np.zeros(len(rep), np.int64), [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            same = lo[a] == hi[a]
            mid = b if same else a + int(np.count_nonzero(side[a:b] == 0))
            for i in range(a, mid):
                others = np.arange(i + 1, b) if same else np.arange(mid, b)
                if not len(others):
                    continue
                near = others[(x[others] * x[i]).sum(axis=1) >= threshold]
                if tab[a] and len(near):  # met before: counted there
                    near = near[~(codes[near, :tab[a]] == codes[i, :tab[a]]).any(axis=1)]
                if len(near):
                    links[i] += times[near].sum()
                    links[near] += times[i]
                    edges.append(np.stack([np.full(len(near), rep[i]), rep[near]], axis=1))
        rows, which = np.unique(rep, return_inverse=True)
        total = np.bincount(which, weights=links, minlength=len(rows)).astype(np.int64)
        root = _roots(rows, np.concatenate(edges))
        keep = total > 0
        return pa.table({"rep": rows[keep], "links": total[keep], "root": root[keep]})

    return run


def _roots(nodes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The smallest node that the edges of one group connect each node to."""
    root = np.arange(len(nodes))
    a, b = np.searchsorted(nodes, edges[:, 0]), np.searchsorted(nodes, edges[:, 1])
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            return nodes[root]


def near_vectors(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row with a vec_id.

    ``embeddings``: vec_id, embedding; other columns are not read. Vectors link when
    the cosine of the originals, in double precision, is at least ``threshold``.
    Unusable vectors (see :func:`vectors.usable`) link with nothing. Equal vectors
    are compared once and all linked to each other. A row that repeats a vec_id
    with the same vector counts once; rows of one vec_id with different vectors
    share a result (their links together). No rows give no rows.
    """
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).filter("vec_id IS NOT NULL").distinct()
    rows = store(usable(embeddings).distinct(), "pstable-vectors")
    groups = rows.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"))
    n = groups.count()
    projections, tables = layout(n, threshold)
    hashed = store(groups.select("rep", "vec", "times").mapInArrow(
        _hash(projections, tables), "rep long, vec binary, times long, codes binary, buckets array<long>"), "pstable-hashed")
    entries = hashed.select("rep", F.posexplode("buckets").alias("tab", "bucket"))
    met = entries.groupBy("tab", "bucket").agg(F.count("*").alias("n")).filter("n > 1") \
        .select("tab", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = store(entries.join(met, ["tab", "bucket"]), "pstable-buckets")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    crossed = placed.withColumn("own", own).withColumn("other", other).select(
        "rep", "tab", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    parts = groups_for(rows.sparkSession, placed.count(), ROWS_PER_GROUP)
    work = crossed.join(hashed.select("rep", "vec", "times", "codes"), "rep") \
        .withColumn("shard", F.pmod(F.xxhash64("tab", "bucket", "lo", "hi"), F.lit(parts)))
    found = store(work.groupBy("shard").applyInArrow(_compare(threshold), "rep long, links long, root long"), "pstable-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    summary = groups.select("vec", "rep", "times").join(links, "rep", "left") \
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("vec", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    results = rows.join(summary, "vec").groupBy("vec_id").agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return every.join(results, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"))
