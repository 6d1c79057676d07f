"""Bit-parity helpers against the SQL engine on boundary values."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.functions import compat

VALUES = [0.125, 0.375, -0.125, 1.005, 2.675, 1.115, 2.5, 3.5, -2.5, 0.045, 1234.565, 99.995,
          -0.005, 0.0, 10.0 / 3, 7.0 / 9, 8.125, 16.6250001, 123456.785]


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame([(v,) for v in VALUES], "x double")


def duck_col(sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE v(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO v VALUES (?, ?)", list(enumerate(VALUES)))
    return [r[0] for r in con.execute(f"SELECT {sql} FROM v ORDER BY i").fetchall()]


def spark_col(values, col):
    # createDataFrame keeps the input order on a single partition
    return [r[0] for r in values.coalesce(1).select(col).collect()]


def test_double_to_decimal_matches(values):
    assert spark_col(values, compat.to_money("x")) == duck_col("x::DECIMAL(10, 2)")


def test_round2_matches(values):
    assert spark_col(values, compat.round2("x")) == duck_col("round(x, 2)")


def test_double_to_int_rounds_half_even(values):
    assert spark_col(values, compat.to_int("x")) == duck_col("x::INTEGER")


def test_seconds_between_counts_boundaries(spark):
    rows = [(dt.datetime(2023, 1, 1, 0, 0, 0, 900000), dt.datetime(2023, 1, 1, 0, 1, 0, 100000)),
            (dt.datetime(2023, 3, 12, 1, 59, 59), dt.datetime(2023, 3, 12, 3, 0, 1)),
            (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1, 0, 0, 0, 200000))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.coalesce(1).select(compat.seconds_between("a", "b")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT date_diff('second', ?::TIMESTAMP, ?::TIMESTAMP)", [a, b]).fetchone()[0]
            for a, b in rows]
    assert got == want == [60, 3602, 1]


def test_seconds_between_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2023, 3, 12, 1, 30), dt.datetime(2023, 3, 12, 3, 30))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert df.select(compat.seconds_between("a", "b")).first()[0] == 7200
        assert df.select(compat.date_key("a")).first()[0] == 20230312
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_calendar_names_and_iso_fields(spark):
    days = [dt.date(2023, 1, 1), dt.date(2024, 12, 30), dt.date(2021, 1, 3), dt.date(2020, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("d", T.DateType())]))
    got = [tuple(r) for r in df.coalesce(1).select(
        F.date_format("d", "MMMM"), F.date_format("d", "EEEE"), compat.iso_day_of_week("d"),
        F.weekofyear("d"), compat.date_key("d")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT monthname(?::DATE), dayname(?::DATE), isodow(?::DATE), weekofyear(?::DATE), "
                        "strftime(?::DATE, '%Y%m%d')::INTEGER", [d] * 5).fetchone() for d in days]
    assert got == [tuple(w) for w in want]


def test_rounding_matches_sql_engine_on_random_doubles(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    ties = st.integers(-8 * 10**7, 8 * 10**7).map(lambda k: k / 8)    # exact .125/.5/... ties
    cents = st.integers(-10**9, 10**9).map(lambda k: k / 1000 + 0.005)  # near cent boundaries
    anyd = st.floats(-1e7, 1e7, allow_nan=False, allow_infinity=False)
    con = duckdb.connect()

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(ties, cents, anyd), min_size=50, max_size=200))
    def check(xs):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").coalesce(1)
        got = [tuple(r) for r in df.orderBy("i").select(compat.round2("x"), compat.to_money("x")).collect()]
        con.execute("CREATE OR REPLACE TABLE v(i BIGINT, x DOUBLE)")
        con.executemany("INSERT INTO v VALUES (?, ?)", list(enumerate(xs)))
        want = con.execute("SELECT round(x, 2), x::DECIMAL(10, 2) FROM v ORDER BY i").fetchall()
        assert got == [tuple(w) for w in want]

    check()


def test_money_overflow_raises_like_the_sql_engine(spark):
    df = spark.createDataFrame([(1e9,)], "x double")
    with pytest.raises(Exception, match="cannot be represented as Decimal"):
        df.select(compat.to_money("x")).collect()
    with pytest.raises(duckdb.Error):
        duckdb.sql("SELECT 1e9::DOUBLE::DECIMAL(10, 2)").fetchall()
