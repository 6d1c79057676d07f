"""Scenario tests of the incremental pipeline on generated landing files."""

import os
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landing_files import month_rows, write
from lakeline.operators.checks import DataTestFailure, accepted_values
from lakeline.plans import pipeline
from lakeline.plans.models import zones_from_tables
from lakeline.plans.pipeline import (
    BRONZE, FACT, REJECTED, SILVER, NoLandingFiles, PeriodClash, Pipeline, RowsLost, TripIdOverflow,
)

SF = "/root/testdata/sf0.001"


def make(spark, workdir, **kw):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing, exist_ok=True)
    p = Pipeline(spark, f"{landing}/*.parquet", os.path.join(workdir, "lake"),
                 zones=zones_from_tables(spark, SF), **kw)
    return p, landing


def counts(p):
    return {n: p.table(t).count() for n, t in
            [("bronze", BRONZE), ("silver", SILVER), ("rejected", REJECTED), ("fact", FACT)]}


def test_empty_landing_first_run_fails(spark, workdir):
    p, _ = make(spark, workdir)
    with pytest.raises(NoLandingFiles):
        p.run()


def test_first_load_add_month_noop_redeliver(spark, workdir):
    p, landing = make(spark, workdir)
    jan = write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"), mtime=time.time() - 100)
    s1 = p.run()
    assert counts(p) == {"bronze": 20, "silver": 15, "rejected": 5, "fact": 15}
    assert s1.stages["bronze"]["files"] == 1
    assert len(s1.tests) == 48

    bronze = p.table(BRONZE)
    rows = bronze.select("_source_row_number", "_source_period", "_batch_id").collect()
    assert sorted(r[0] for r in rows) == list(range(20))
    assert {str(r[1]) for r in rows} == {"2023-01-01"}
    reasons = {r[0]: r[1] for r in p.table(REJECTED).groupBy("_reject_reason").count().collect()}
    assert reasons == {"duplicate": 1, "invalid_distance": 1, "invalid_amount": 1,
                       "unknown_location": 1, "missing_timestamp": 1}
    trip_ids = [r[0] for r in p.table(SILVER).select("trip_id").collect()]
    assert all(202301 * 10**8 <= t < 202301 * 10**8 + 20 for t in trip_ids)

    # February arrives with drifted types/names and a missing column.
    write(f"{landing}/trips_2023-02.parquet", month_rows("2023-02", bad=False),
          overrides={"VendorID": pa.int32(), "passenger_count": pa.int64(), "PULocationID": pa.int32()},
          rename={"airport_fee": "Airport_fee"}, drop=("congestion_surcharge",))
    s2 = p.run()
    assert s2.stages["bronze"]["files"] == 1
    assert s2.stages["silver"]["files"] == 1
    assert counts(p) == {"bronze": 40, "silver": 35, "rejected": 5, "fact": 35}
    feb = p.table(SILVER).where(F.col("_source_period") == "2023-02-01")
    assert feb.where(F.col("congestion_surcharge_amount") != 0).count() == 0
    summary = p.table("gold/fact_daily_zone_summary").agg(F.sum("trip_count")).first()[0]
    assert summary == 35

    # Nothing new: every incremental stage is a no-op.
    s3 = p.run()
    assert s3.stages["bronze"]["files"] == 0
    assert s3.stages["silver"]["files"] == 0 and s3.stages["fact"]["files"] == 0
    assert counts(p) == {"bronze": 40, "silver": 35, "rejected": 5, "fact": 35}

    # January is re-delivered with corrected fares: its rows are replaced everywhere.
    write(jan, month_rows("2023-01", fare_scale=2.0), mtime=time.time())
    s4 = p.run()
    assert s4.stages["bronze"]["files"] == 1
    assert counts(p) == {"bronze": 40, "silver": 35, "rejected": 5, "fact": 35}
    fares = p.table(FACT).where(F.col("pickup_at") < "2023-02-01").agg(F.min("fare_amount")).first()[0]
    assert float(fares) == 16.0
    batches = p.table(FACT).where(F.col("pickup_at") < "2023-02-01").select("_batch_id").distinct().collect()
    assert [b[0] for b in batches] == [s4.batch_id]

    # Re-delivered again without any bad row: the old rejects must go too.
    write(jan, month_rows("2023-01", bad=False), mtime=time.time() + 10)
    p.run()
    assert counts(p) == {"bronze": 40, "silver": 40, "rejected": 0, "fact": 40}


def test_strict_reference_keeps_stale_rejects(spark, workdir):
    p, landing = make(spark, workdir, strict_reference=True)
    jan = write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"), mtime=time.time() - 100)
    p.run()
    write(jan, month_rows("2023-01", bad=False), mtime=time.time())
    p.run()
    c = counts(p)
    assert c["silver"] == 20 and c["rejected"] == 5


def test_unknown_period_and_bad_month(spark, workdir):
    p, landing = make(spark, workdir, run_tests=False)
    write(f"{landing}/misc.parquet", month_rows("2023-03", n=4, bad=False))
    write(f"{landing}/trips_2023_13.parquet", month_rows("2023-03", n=3, bad=False))
    write(f"{landing}/trips_2023_03.parquet", month_rows("2023-03", n=5, bad=False))
    p.run()
    reasons = {r[0]: r[1] for r in p.table(REJECTED).groupBy("_reject_reason").count().collect()}
    assert reasons == {"unknown_source_period": 7}
    assert p.table(SILVER).count() == 5


def test_null_location_passes_rules_but_fails_gate(spark, workdir):
    p, landing = make(spark, workdir)
    rows = month_rows("2023-01", bad=False)
    rows[4]["PULocationID"] = None
    jan = write(f"{landing}/trips_2023_01.parquet", rows)
    for _ in range(3):  # the gate holds however often the run is repeated
        with pytest.raises(DataTestFailure, match="pickup_location_id"):
            p.run()
        assert p.table(SILVER).count() == 20
        assert not os.path.exists(os.path.join(p.root, "gold", "fact_trips"))
    write(jan, month_rows("2023-01", bad=False), mtime=time.time() + 5)
    p.run()
    assert counts(p)["fact"] == 20


def test_gate_holds_on_an_incremental_run(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    p.run()
    rows = month_rows("2023-02", bad=False)
    rows[4]["PULocationID"] = None
    write(f"{landing}/trips_2023_02.parquet", rows)
    for _ in range(3):
        with pytest.raises(DataTestFailure, match="pickup_location_id"):
            p.run()
        assert p.table(FACT).count() == 20  # February never gets there


@pytest.mark.parametrize("layer, table", [("bronze", SILVER), ("gold", None)])
def test_other_layers_gate_every_run(spark, workdir, monkeypatch, layer, table):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    real = pipeline.model_tests

    def broken():
        tests = real()
        model, column = {"bronze": ("bronze_yellow_tripdata", "store_and_fwd_flag"), "gold": ("fact_trips", "_source_file")}[layer]
        return tests | {layer: [*tests[layer], accepted_values(model, column, ["nothing"])]}

    monkeypatch.setattr(pipeline, "model_tests", broken)
    for _ in range(3):
        with pytest.raises(DataTestFailure, match="accepted_values"):
            p.run()
        assert table is None or not p.exists(table)
    monkeypatch.setattr(pipeline, "model_tests", real)
    p.run()
    assert p.run().stages["gold"].keys() == {"seconds"}  # and only now there is nothing left to do


def test_too_many_rows_fail_every_run(spark, workdir, monkeypatch):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    monkeypatch.setattr(pipeline.quality, "TRIP_ID_ROW_LIMIT", 10)
    for _ in range(3):
        with pytest.raises(TripIdOverflow):
            p.run()
        assert not p.exists(SILVER)


def test_two_files_of_one_month_are_refused(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    p.run()
    write(f"{landing}/trips_2023-01.parquet", month_rows("2023-01", bad=False))
    for _ in range(2):
        with pytest.raises(PeriodClash, match="2023-01"):
            p.run()
    assert counts(p)["bronze"] == 20


def test_rows_missing_in_silver_stop_the_run(spark, workdir, monkeypatch):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    real = pipeline.quality.classify
    monkeypatch.setattr(pipeline.quality, "classify", lambda *a, **k: real(*a, **k).where("trip_id % 2 = 0"))
    for _ in range(2):
        with pytest.raises(RowsLost, match="20 rows"):
            p.run()
        assert not p.exists(FACT)


@pytest.mark.parametrize("name", ["trips feb_{}.parquet", "trips%20feb_{}.parquet", "trips#feb_{}.parquet", "trips+feb_{}.parquet"])
def test_file_names_that_uris_escape(spark, workdir, name):
    p, landing = make(spark, workdir)
    write(f"{landing}/{name.format('2023_01')}", month_rows("2023-01"))
    p.run()
    feb = write(f"{landing}/{name.format('2023_02')}", month_rows("2023-02"), mtime=time.time() - 50)
    p.run()
    assert counts(p) == {"bronze": 40, "silver": 30, "rejected": 10, "fact": 30}
    write(feb, month_rows("2023-02", bad=False), mtime=time.time())
    p.run()
    assert counts(p) == {"bronze": 40, "silver": 35, "rejected": 5, "fact": 35}
    assert p.run().stages["bronze"]["files"] == 0


def test_a_file_restored_after_a_full_refresh_is_loaded(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    feb = write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", bad=False), mtime=time.time() - 100)
    p.run()
    aside = os.path.join(workdir, "aside.parquet")
    os.rename(feb, aside)
    p.run(full_refresh=True)
    assert counts(p)["fact"] == 20
    os.rename(aside, feb)  # back with its old modification time
    assert p.run().stages["bronze"]["files"] == 1
    assert counts(p) == {"bronze": 40, "silver": 40, "rejected": 0, "fact": 40}


def test_a_full_refresh_that_dies_in_gold_is_completed(spark, workdir, monkeypatch):
    p, landing = make(spark, workdir)
    jan = write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False), mtime=time.time() - 100)
    p.run()
    write(jan, month_rows("2023-01", bad=False, fare_scale=2.0), mtime=time.time())
    real = Pipeline.gold

    def dies(self, *a, **k):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(Pipeline, "gold", dies)
    with pytest.raises(RuntimeError, match="executor lost"):
        p.run(full_refresh=True)
    monkeypatch.setattr(Pipeline, "gold", real)
    p.run()
    total = F.sum("fare_amount")
    assert p.table("gold/fact_daily_zone_summary").agg(total).first()[0] == p.table(FACT).agg(total).first()[0]


def test_code_lists_come_from_csv_files(spark, workdir):
    p, landing = make(spark, workdir)
    rows = month_rows("2023-01", bad=False)
    rows[2]["VendorID"] = 42
    write(f"{landing}/trips_2023_01.parquet", rows)
    csv = os.path.join(workdir, "vendors.csv")
    with open(csv, "w") as f:
        f.write('vendor_id,vendor_name\n1,"Creative Mobile, LLC"\n42,"New, Inc"\n')
    with_csv = Pipeline(spark, p.glob, p.root, zones=p.zones, vendors=csv)
    with_csv.run()
    assert {tuple(r) for r in with_csv.table("gold/dim_vendor").collect()} == {(1, "Creative Mobile, LLC"), (42, "New, Inc")}
    with open(csv, "a") as f:
        f.write("42,Again\n")
    again = Pipeline(spark, p.glob, os.path.join(workdir, "other"), zones=p.zones, vendors=csv)
    with pytest.raises(DataTestFailure, match="vendors.vendor_id"):
        again.run()


def test_publish_refuses_to_drop_a_managed_table(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    p.run()
    spark.sql("CREATE DATABASE IF NOT EXISTS t2_gold")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t2_gold LOCATION '{workdir}/t2'")
    spark.range(3).write.mode("overwrite").saveAsTable("t2_gold.dim_date")
    with pytest.raises(ValueError, match="delete its data"):
        p.publish(prefix="t2")
    assert spark.table("t2_gold.dim_date").count() == 3
    spark.sql("DROP TABLE t2_gold.dim_date")


def test_full_refresh_rebuilds(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    p.run()
    s = p.run(full_refresh=True)
    assert s.stages["bronze"]["files"] == 1
    assert counts(p) == {"bronze": 20, "silver": 15, "rejected": 5, "fact": 15}


AUDIT = ("_processed_at", "_ingested_at", "_batch_id", "_source_modified_at")


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(c for c in df.columns if c not in AUDIT)).collect())


def test_incremental_gold_equals_a_full_rebuild(spark, workdir):
    p, landing = make(spark, workdir)
    jan = write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", n=30), mtime=time.time() - 100)
    p.run()
    write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", n=25))
    p.run()
    # January re-delivered: fewer rows and new values; one day loses all its trips
    rows = [r for i, r in enumerate(month_rows("2023-01", n=30, fare_scale=3.0)) if i % 27 != 0]
    write(jan, rows, mtime=time.time())
    s = p.run()
    assert s.stages["gold"]["fact_daily_zone_summary"] > 0 and "dim_location" not in s.stages["gold"]

    fresh = Pipeline(spark, p.glob, os.path.join(workdir, "lake-full"), zones=zones_from_tables(spark, SF))
    fresh.run()
    for name in ["gold/fact_daily_zone_summary", "gold/dim_date", "gold/dim_vendor", "gold/dim_rate_code",
                 "gold/dim_payment_type", FACT, SILVER, REJECTED]:
        assert _rows(p.table(name)) == _rows(fresh.table(name)), name


def test_changed_lookup_rechecks_all_facts(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    p.run()
    used = p.table(FACT).select("pickup_location_id").first()[0]
    p.zones = zones_from_tables(spark, SF).where(F.col("location_id") != used)
    with pytest.raises(DataTestFailure, match="pickup_location_id->dim_location"):
        p.run()


def test_published_tables_answer_the_consumer_sql(spark, workdir):
    from lakeline.plans.star import star_month_borough

    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", bad=False))
    p.run()
    names = p.publish(prefix="t1")
    assert "t1_gold.fact_trips" in names and "t1_bronze.bronze_yellow_tripdata" in names
    got = spark.sql("""
        WITH trips AS (SELECT pickup_date_key AS date_key, pickup_location_id AS location_id, total_amount FROM t1_gold.fact_trips)
        SELECT month_name, borough, count(total_amount) AS trips, sum(total_amount) AS revenue
        FROM trips JOIN t1_gold.dim_date USING (date_key) JOIN t1_gold.dim_location USING (location_id)
        GROUP BY ALL""")
    want = star_month_borough(p.table(FACT), p.table("gold/dim_date"), p.table("gold/dim_location"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.table("t1_silver.silver_yellow_trips").count() == 35
    assert dict(spark.table("t1_silver.silver_yellow_trips").dtypes)["_source_period"] == "date"
    assert "pickup_month" not in spark.table("t1_gold.fact_trips").columns  # a layout column, not in the contract
    p.run(full_refresh=True)
    p.publish(prefix="t1")  # again, onto the new versions
    assert spark.table("t1_gold.fact_trips").count() == 35


def test_command_line_run(spark, workdir, capsys):
    import json

    from lakeline.__main__ import main

    landing = os.path.join(workdir, "landing")
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    zones_csv = os.path.join(workdir, "zones")
    zones_from_tables(spark, SF).write.option("header", True).csv(zones_csv)
    code = main(["--landing", f"{landing}/*.parquet", "--root", os.path.join(workdir, "lake"),
                 "--zones", zones_csv, "--var", "max_fare_amount=20"])
    assert code == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["stages"]["silver"]["valid"] < 15  # the lower fare cap rejects more rows


def test_a_failed_gold_stage_is_completed_by_the_next_run(spark, workdir, monkeypatch):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01"))
    p.run()
    write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", bad=False))
    real_gold = Pipeline.gold

    def failing_gold(self, *a, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(Pipeline, "gold", failing_gold)
    with pytest.raises(RuntimeError):
        p.run()
    monkeypatch.setattr(Pipeline, "gold", real_gold)
    s = p.run()  # bronze, silver, fact have nothing new; gold still owes February
    assert s.stages["fact"]["files"] == 0 and "fact_daily_zone_summary" in s.stages["gold"]
    fresh = Pipeline(spark, p.glob, os.path.join(workdir, "lake-full"), zones=zones_from_tables(spark, SF))
    fresh.run()
    for name in ["gold/fact_daily_zone_summary", "gold/dim_date", "gold/dim_vendor"]:
        assert _rows(p.table(name)) == _rows(fresh.table(name)), name


def test_load_logs_are_compacted(spark, workdir):
    from lakeline.operators import sinks

    p, landing = make(spark, workdir, log_max_files=1, run_tests=False)
    for m in ("01", "02", "03"):
        write(f"{landing}/trips_2023_{m}.parquet", month_rows(f"2023-{m}", bad=False))
        p.run()
    log = p.log_path(BRONZE)
    assert sinks.data_file_count(spark, log) == 1
    assert sinks.read_table(spark, log).count() == 3
    assert counts(p)["fact"] == 60


def test_failing_lookup_test_stops_gold_only(spark, workdir):
    p, landing = make(spark, workdir)
    write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False))
    p.zones = zones_from_tables(spark, SF).unionByName(zones_from_tables(spark, SF).limit(1))  # duplicate id
    with pytest.raises(DataTestFailure, match="unique"):
        p.run()
    assert p.table(FACT).count() == 20  # the layers that do not use lookups were built
    assert not os.path.exists(os.path.join(p.root, "gold", "dim_location"))


def test_published_tables_follow_every_run(spark, workdir):
    """A table published once and a DataFrame opened once answer across three more runs."""
    p, landing = make(spark, workdir, run_tests=False)
    jan = write(f"{landing}/trips_2023_01.parquet", month_rows("2023-01", bad=False), mtime=time.time() - 100)
    p.run()
    p.publish("moved")
    opened = p.table("gold/fact_daily_zone_summary")
    total = F.sum("total_amount")
    first = opened.agg(F.sum("trip_count")).first()[0]
    write(jan, month_rows("2023-01", bad=False, fare_scale=2.0), mtime=time.time())
    p.run()
    again = Pipeline(spark, p.glob, p.root, zones=p.zones, run_tests=False)  # knows the prefix from the lake
    write(f"{landing}/trips_2023_02.parquet", month_rows("2023-02", bad=False))
    again.run()
    again.run(full_refresh=True)
    assert opened.agg(F.sum("trip_count")).first()[0] == first == 20
    for name, published in ((BRONZE, "moved_bronze.bronze_yellow_tripdata"), (SILVER, "moved_silver.silver_yellow_trips"),
                            (FACT, "moved_gold.fact_trips"), ("gold/fact_daily_zone_summary", "moved_gold.fact_daily_zone_summary")):
        assert spark.table(published).count() == p.table(name).count() > 20
    assert spark.table("moved_gold.fact_trips").agg(total).first()[0] == p.table(FACT).agg(total).first()[0]
    # the bounds of the published function reach the partitions
    spark.sql("USE moved_gold")
    feb = spark.sql("SELECT * FROM fact_trips_between(TIMESTAMP_NTZ'2023-02-01', TIMESTAMP_NTZ'2023-03-01')")
    spark.sql("USE default")
    assert feb.count() == 20 and "pickup_month" not in feb.columns
    assert "pickup_month" in feb._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert p.table(FACT, since="2023-02-01", until="2023-03-01").count() == 20
    with pytest.raises(ValueError):
        p.table(BRONZE, since="2023-02-01")
    shown = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES moved_gold.fact_daily_zone_summary").collect()}
    assert shown["lakeline.layer"] == "gold" and int(shown["lakeline.rows"]) == spark.table("moved_gold.fact_daily_zone_summary").count()
