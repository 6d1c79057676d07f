"""Every registered query against its DuckDB oracle, plus the entry smoke check."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from lakeline.plans import registry
from oracle_compare import assert_same, duck

# of the library itself; the training-data queries have tests of their own
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF001).toArrow()
    want = con.sql(ORACLES[key]).to_arrow_table()
    assert_same(got, want)


def test_landing_listing_lists_every_landing_file(spark):
    names = {r["landing_name"] for r in QUERIES["landing_listing"](spark, SF001).collect()}
    assert "misc.parquet" in names
    assert all(n.startswith("trips_") or n == "misc.parquet" for n in names)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month_name", "borough", "trips", "revenue"]
    assert df.count() > 0


def test_reject_counts_match_published_fixture_counts(spark):
    """FIXTURES.md lists the outcome counts at sf0.01 (rules run in DuckDB)."""
    got = {r["outcome"]: r["row_count"] for r in
           QUERIES["reject_reason_counts"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {
        "valid": 43330, "duplicate": 1176, "unknown_source_period": 637, "missing_timestamp": 625,
        "pickup_outside_file_month": 612, "invalid_duration": 2559, "invalid_distance": 3430,
        "implausible_speed": 2864, "invalid_amount": 5082, "unknown_location": 861,
    }


def test_clear_scratch_removes_this_applications_folders(spark):
    import os

    from lakeline.session import _CREATED, clear_scratch

    QUERIES["fact_trips"](spark, SF001).count()
    app = spark.sparkContext.applicationId
    paths = [p for p in _CREATED.get(app, []) if os.path.exists(p.replace("file:", ""))]
    assert paths
    assert clear_scratch(spark) >= len(paths)
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)
    assert QUERIES["fact_trips"](spark, SF001).count() > 0  # layers are rebuilt on demand
