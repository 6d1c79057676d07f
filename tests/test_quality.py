"""Each silver rule at its boundaries, first-match order and NULL handling."""

import datetime as dt

import pytest
from pyspark.sql import Row

from lakeline.config import BRONZE_CONTRACT, Thresholds
from lakeline.operators import quality
from lakeline.sources.landing import typed_empty

T0 = dt.datetime(2023, 1, 10, 12, 0, 0)


def bronze_row(row=0, file="s3://b/landing/yellow_tripdata_2023_01.parquet", secs=600, distance=2.0,
               fare=10.0, total=12.0, pu=10, do=20, pickup=T0, vendor=1, passengers=1.0, rate=1.0):
    values = {n: None for n, _ in BRONZE_CONTRACT}
    values.update(vendorid=vendor, tpep_pickup_datetime=pickup,
                  tpep_dropoff_datetime=None if pickup is None or secs is None else pickup + dt.timedelta(seconds=secs),
                  passenger_count=passengers, trip_distance=distance, ratecodeid=rate, store_and_fwd_flag="N",
                  pulocationid=pu, dolocationid=do, payment_type=1, fare_amount=fare, total_amount=total)
    values.update(_source_file=file, _source_row_number=row)
    return values


def classify_rows(spark, rows, th=Thresholds()):
    schema = typed_empty(spark).schema.add("_source_file", "string").add("_source_row_number", "long")
    df = spark.createDataFrame([Row(**r) for r in rows], schema)
    from lakeline.sources.landing import source_period
    df = df.withColumn("_source_period", source_period("_source_file")).withColumn(
        "_batch_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("b"))
    out = quality.classify(df, th).orderBy("_source_row_number").collect()
    return [r["_reject_reason"] for r in out]


CASES = [
    (dict(secs=59, distance=1.0), "invalid_duration"), (dict(secs=60, distance=1.0), None),
    (dict(secs=21600, distance=2.0), None), (dict(secs=21601), "invalid_duration"),
    (dict(distance=0.0), "invalid_distance"), (dict(distance=None), "invalid_distance"),
    (dict(distance=float("nan")), "invalid_distance"),
    # 500 mi passes the distance rule (and is then too fast for 6 h); 500.01 does not
    (dict(distance=500.0, secs=21600), "implausible_speed"), (dict(distance=500.01, secs=21600), "invalid_distance"),
    (dict(distance=80.0, secs=3600), None), (dict(distance=80.01, secs=3600), "implausible_speed"),
    (dict(fare=0.0), "invalid_amount"), (dict(fare=2000.0, total=2001.0), None),
    (dict(fare=2000.01, total=2001.0), "invalid_amount"), (dict(total=None), "invalid_amount"),
    (dict(fare=2000.004, total=2001.0), None),  # rounds to 2000.00 first
    (dict(pu=0), "unknown_location"), (dict(pu=1), None), (dict(do=265), None), (dict(do=266), "unknown_location"),
    (dict(pu=None), None),  # NULL is not outside the range: the not_null test catches it
    (dict(pickup=None), "missing_timestamp"), (dict(secs=None), "missing_timestamp"),
    (dict(pickup=dt.datetime(2022, 12, 31, 23, 59)), "pickup_outside_file_month"),
    (dict(file="s3://b/landing/misc.parquet"), "unknown_source_period"),
    (dict(file="s3://b/landing/yellow_tripdata_2023_13.parquet"), "unknown_source_period"),
    (dict(file="s3://b/landing/yellow_tripdata_2023-01.parquet"), None),
    # first match wins: bad duration and bad amount -> duration
    (dict(secs=30, fare=-1.0), "invalid_duration"),
]


@pytest.mark.parametrize("kw,reason", CASES)
def test_rule_boundaries(spark, kw, reason):
    assert classify_rows(spark, [bronze_row(**kw)]) == [reason]


def test_duplicate_is_tested_first_and_keeps_lowest_row(spark):
    a = bronze_row(row=5, secs=30)
    rows = [a, dict(a, _source_row_number=2), dict(a, _source_row_number=9),
            bronze_row(row=3, file="s3://b/landing/yellow_tripdata_2023-01.parquet", secs=30)]
    # same trip in another file is not a duplicate
    assert classify_rows(spark, rows) == ["invalid_duration", "invalid_duration", "duplicate", "duplicate"]


def test_null_keys_group_together_for_duplicates(spark):
    a = bronze_row(row=0, pu=None, vendor=None)
    assert classify_rows(spark, [a, dict(a, _source_row_number=1)]) == [None, "duplicate"]


def test_zero_minimum_duration_uses_guarded_speed(spark):
    th = Thresholds(min_trip_duration_minutes=0)
    assert classify_rows(spark, [bronze_row(secs=0, distance=1.0)], th) == ["implausible_speed"]


def test_passenger_and_rate_code_standardisation(spark):
    schema = typed_empty(spark).schema.add("_source_file", "string").add("_source_row_number", "long")
    rows = [bronze_row(row=i, passengers=p, rate=r) for i, (p, r) in
            enumerate([(0.0, None), (6.0, 2.5), (7.0, 3.5), (2.5, 1.0)])]
    df = spark.createDataFrame([Row(**r) for r in rows], schema)
    from pyspark.sql import functions as F
    from lakeline.sources.landing import source_period
    df = df.withColumn("_source_period", source_period("_source_file")).withColumn("_batch_id", F.lit("b"))
    got = [(r.passenger_count, r.rate_code_id) for r in
           quality.typed_trips(df).orderBy("_source_row_number").collect()]
    assert got == [(None, 99), (6, 2), (None, 4), (2, 1)]
