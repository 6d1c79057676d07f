"""Vector search and vector near-duplicates against brute force."""

import numpy as np
import pytest

from lakeline.llm import multi_index, pstable

SCHEMA = "vec_id long, embedding array<float>, label string, rank int, vec string"


def awkward():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 24)).astype(np.float32)
    x[50:90] = x[50] + 0.02 * rng.standard_normal((40, 24)).astype(np.float32)  # near copies
    x[100:140] = x[100]  # equal ones
    x[200] = x[100] * 3  # same direction, longer
    x[210] = -x[100]
    rows = [(i * 5, v.tolist(), "l", 1, "v") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 7]
    rows += [(10_000 + i * 20, v, None, None, None) for i, v in enumerate(odd)]
    rows += [(None, [1.0] * 24, None, None, None), rows[3], rows[3]]
    return rows, {i * 5: v.astype(np.float64) for i, v in enumerate(x)}


def test_every_code_in_the_radius_is_found():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (3_000, 8)).astype(np.uint16)
    codes[500:] = codes[0] ^ (1 << rng.integers(0, 16, (2_500, 8))).astype(np.uint16) * (rng.random((2_500, 8)) < 0.5)
    index = multi_index.Index(codes)
    for radius in (0, 3, 7, 8, 20, 60, 128):
        far = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_nearest_on_a_small_table(spark):
    rows, vectors = awkward()
    got = multi_index.nearest(spark.createDataFrame(rows, SCHEMA), every=20, neighbours=20).collect()
    ids = np.array(sorted(vectors))
    x = np.stack([vectors[i] for i in ids.tolist()])
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(by_query) == {i for i in vectors if i % 20 == 0}
    right = total = 0
    for q, found in by_query.items():
        assert sorted(found) == list(range(1, 21))
        score = (x * vectors[q]).sum(axis=1)
        at = {i: s for i, s in zip(ids.tolist(), score)}
        listed = [found[k] for k in range(1, 21)]
        assert q not in [v for v, _ in listed]
        assert all(abs(at[v] - s) < 1e-12 for v, s in listed)
        assert listed == sorted(listed, key=lambda v: (-v[1], v[0]))
        best = sorted((i for i in ids.tolist() if i != q), key=lambda i: (-at[i], i))[:20]
        right += len(set(best) & {v for v, _ in listed})
        total += 20
    assert right >= 0.95 * total


def test_recall_on_the_given_table(spark):
    from tests.conftest import SF01

    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    got = multi_index.nearest(table).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    right = total = 0
    for q in ids[ids % 20 == 0].tolist():
        score = x @ x[ids == q][0]
        order = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != q][:20]
        right += len(set(order) & found[q])
        total += len(order)
    assert right >= 0.9 * total


def test_few_candidates_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in multi_index.nearest(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5), (20, 3, 2, 0.5)]
    assert multi_index.nearest(few.limit(0)).count() == 0


def brute(vectors, threshold=0.95):
    ids = sorted(vectors)
    x = np.stack([vectors[i] for i in ids])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: (int(near[i].sum()), ids[root(i)]) for i, v in enumerate(ids)}


@pytest.mark.parametrize("block", [1_024, 8])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pstable, "BLOCK", block)  # 8: buckets are split
    rows, vectors = awkward()
    got = {r["vec_id"]: r for r in pstable.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    expected = brute(vectors)
    assert set(got) == {r[0] for r in rows if r[0] is not None}
    for i, r in got.items():
        assert (r["n_links"], r["component_id"]) == expected.get(i, (0, i))
        assert r["kept"] == (r["component_id"] == i)


def test_near_vectors_on_the_given_table(spark):
    from tests.conftest import SF01

    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in table.collect()}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pstable.near_vectors(table).collect()}
    assert got == brute(vectors)
    assert pstable.near_vectors(table.limit(0)).count() == 0
