"""The pipeline against its stages' brute force; every query over its whole tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF001

QUERIES = [k for k in entry.queries() if k.startswith("op")]


def test_names():
    numbers = [int(k[2:].split("_")[0]) for k in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", QUERIES)
def test_every_row_has_a_result(spark, name):
    got = entry.queries()[name](spark, SF001)
    key = {"op8_multi_index": "query_id", "op9_url_filter": "page_id", "op10_pstable": "vec_id"}.get(name, "doc_id")
    table, column = {"query_id": ("embeddings", "vec_id"), "vec_id": ("embeddings", "vec_id"), "page_id": ("pages", "page_id"),
                     "doc_id": ("documents", "doc_id")}[key]
    ids = {r[0] for r in spark.read.parquet(f"{SF001}/{table}.parquet").select(column).collect()}
    if key == "query_id":
        ids = {i for i in ids if i % 20 == 0}
    assert {r[0] for r in got.select(key).collect()} == ids


def test_url_oracle(spark):
    got = entry.queries()["op9_url_filter"](spark, SF001).toPandas()
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF001}/pages.parquet'")
    expected = duckdb.sql(entry.oracle_sql()["op9_url_filter"]).df()
    pick = lambda d: sorted(map(str, d[sorted(d.columns)].where(d.notna(), None).values.tolist()))
    assert pick(got) == pick(expected)


def test_pipeline_against_brute_force(spark):
    """Stage by stage on the small table: what goes, what stays, and the bytes that are left."""
    from tests.llm.test_repeats_small import bytes_brute

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    before = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.store(stage(spark, before, SF001), "test-stage")
        assert after.schema.names == docs.schema.names
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        kept.append(after)
        before = after
    good, unique, cleaned = kept
    verdict = {r["doc_id"]: r["kept"] for r in entry.queries()["op7_importance"](spark, SF001).collect()}
    assert {r["doc_id"] for r in good.collect()} == {d for d, k in verdict.items() if k}
    rows = [(r["text"], r["doc_id"]) for r in unique.collect()]
    text = {r["doc_id"]: r for r in cleaned.collect()}
    assert set(text) == {d for _, d in rows}
    for d, _, removed, _, sha in bytes_brute(rows):
        if removed == 0 or text[d]["text"].isascii():
            assert hashlib.sha256(text[d]["text"].encode()).hexdigest() == sha or not text[d]["text"].isascii()
        assert text[d]["n_chars"] == len(text[d]["text"])
    packed = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"] for r in packed} == set(text)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0


def test_bench_times_every_query_by_default():
    import bench

    registered = entry.queries()
    assert bench.chosen("", registered) == list(registered)
    assert set(QUERIES) | {"pipeline"} <= set(bench.chosen("", registered))
    assert bench.chosen("op9_url_filter,", registered) == ["op9_url_filter"]
