"""Physical plan shape of the main operators (pruning, pushdown, joins)."""

import re

from pyspark.sql import functions as F

from conftest import SF001
from lakeline.operators import checks, facts, quality
from lakeline.operators.incremental import source_file_filter
from lakeline.plans.models import stored_models
from lakeline.plans.pipeline import model_tests
from lakeline.plans.star import star_month_borough


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p):
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", p)


def test_star_query_reads_gold_only_and_prunes_fact(spark):
    m = stored_models(spark, SF001)
    p = plan(star_month_borough(m.fact, m.dim_date, m.dim_location))
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p  # both turn out small here
    schemas = read_schemas(p)
    assert len(schemas) == 3 and not any("pickup_at" in s or "dropoff_at" in s for s in schemas)  # no scan of silver
    fact_scan = [s for s in schemas if "pickup_date_key" in s][0]
    assert fact_scan == "struct<pickup_date_key:int,pickup_location_id:int,total_amount:decimal(10,2)>"
    assert "partial_sum" in p and "partial_count" in p


def test_all_relationships_of_fact_scan_it_once(spark):
    m = stored_models(spark, SF001)
    tests = [t for t in model_tests()["gold"] if t.kind == "relationships" and t.model == "fact_trips"]
    assert len(tests) == 8
    tables = {t.to_model: getattr(m, t.to_model) for t in tests}
    p = plan(checks.relationship_results("fact_trips", m.fact, tests, tables))
    assert len(re.findall(r"ReadSchema: struct<pickup_date_key", p)) == 1
    assert "partial_count" in p


def test_classify_has_no_window_and_no_row_shuffle(spark):
    m = stored_models(spark, SF001)
    p = plan(quality.classify(m.bronze))
    assert "Window" not in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "Exchange hashpartitioning" not in p  # rows stay in their scan tasks


def test_summary_aggregates_partially_before_the_shuffle(spark):
    p = plan(facts.fact_daily_zone_summary(stored_models(spark, SF001).fact))
    assert "partial_sum" in p and "partial_count" in p


def test_fact_projection_reads_only_needed_silver_columns(spark):
    silver = stored_models(spark, SF001).silver
    p = plan(facts.fact_trips(silver).select("trip_id", "avg_speed_mph"))
    (schema,) = read_schemas(p)
    assert set(re.findall(r"(\w+):", schema)) == {"trip_id", "trip_distance_miles", "trip_duration_minutes"}


def test_pending_files_prune_partitions(spark, workdir):
    bronze = stored_models(spark, SF001).bronze
    bronze.write.partitionBy("_source_period", "_source_file").parquet(f"{workdir}/b")
    table = spark.read.parquet(f"{workdir}/b")
    p = plan(source_file_filter(table, ["landing/trips_1996_03.parquet"]))
    assert re.search(r"PartitionFilters: \[[^\]]*_source_period", p) and "LeftSemi" in p
    p2 = plan(table.where(F.col("fare_amount") > 10).select("fare_amount"))
    assert "PushedFilters: [IsNotNull(fare_amount), GreaterThan(fare_amount,10.0)]" in p2


def _below(p: str, node: str) -> str:
    """All lines of plan text that stand below a line with ``node``."""
    out, inside = [], None
    for line in p.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            out.append(line)
            continue
        inside = depth if node in line else None
    return "\n".join(out)


def test_keep_first_beyond_the_broadcast_limit_shuffles_candidates_only(spark):
    from lakeline.config import DEDUP_KEYS

    m = stored_models(spark, SF001)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = quality.flag_repeats(quality.typed_trips(m.bronze), DEDUP_KEYS, "_source_row_number", "_repeat")
        p = plan(flagged)
        assert "Union" in p and "repeat-candidates" in p
        for exchange in ("Exchange hashpartitioning", "Exchange rangepartitioning"):
            assert "trips-bronze" not in _below(p, exchange)  # the rows of the input are never shuffled
        n = spark.read.parquet(re.search(r"InMemoryFileIndex\(1 paths\)\[(\S*repeat-candidates[^\]]*)\]", p).group(1)).count()
        total, repeats = flagged.count(), flagged.where("_repeat").count()
        assert total == m.bronze.count() and 2 * repeats <= n <= 2 * repeats + 0.1 * total
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pickup_bounds_prune_months(spark, workdir):
    from lakeline.plans.pipeline import picked_up_between

    fact = stored_models(spark, SF001).fact.withColumn("pickup_month", F.trunc("pickup_at", "MM"))
    fact.write.partitionBy("pickup_month").parquet(f"{workdir}/fact")
    table = spark.read.parquet(f"{workdir}/fact")
    since, until = "1996-02-10 00:00:00", "1996-04-02 08:00:00"
    got = picked_up_between(table, "pickup_month", since, until)
    p = plan(got)
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_month#\d+ >= 1996-02-01[^\]]*pickup_month#\d+ <= 1996-04-01", p)
    want = fact.where(f"pickup_at >= timestamp_ntz'{since}' and pickup_at < timestamp_ntz'{until}'")
    assert got.count() == want.count() > 0
    assert len(got.inputFiles()) <= len(table.inputFiles())
