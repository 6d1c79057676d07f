"""Skew-proof operators agree with the naive window formulation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeline.operators.positions import position_within
from lakeline.operators.quality import flag_repeats


def skewed(spark, n=20000):
    # group "hot" holds ~90% of the rows, with many exact copies
    return spark.range(n).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .alias("g"),
        (F.col("id") % 37).alias("k1"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("k2"),
        F.col("id").alias("row"),
    )


def test_position_within_matches_row_number(spark):
    df = skewed(spark)
    got = position_within(df, "g", ["k1", "row"], "pos", num_partitions=16)
    w = Window.partitionBy("g").orderBy("k1", "row")
    want = df.withColumn("pos", F.row_number().over(w) - 1)
    assert got.select("g", "row", "pos").exceptAll(want.select("g", "row", "pos")).count() == 0
    assert got.count() == df.count()


def test_position_within_keeps_payload_columns_right(spark):
    """Columns outside the order keys must not change which range a row is counted in."""
    df = spark.range(250_000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.xxhash64("id").alias("k"), F.col("id").alias("row"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    got = position_within(df, "g", ["k", "row"], "pos", num_partitions=8)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k", "row")) - 1)
    assert got.columns == [*df.columns, "pos"]
    wrong = got.join(want.select("row", F.col("pos").alias("want")), "row").where("pos <> want OR payload IS NULL")
    assert wrong.count() == 0 and got.count() == 250_000


def test_position_within_spreads_a_hot_group(spark):
    df = skewed(spark)
    got = position_within(df, "g", ["k1", "row"], "pos", num_partitions=16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    (folder,) = set(re.findall(r"InMemoryFileIndex[^\[]*\[([^\], ]*/positions-\w+)", plan))
    sizes = [r[0] for r in spark.read.parquet(folder).groupBy("_pos_task").count().select("count").collect()]
    assert len(sizes) > 8 and max(sizes) < 0.25 * df.count()


import re

import pytest


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_flag_repeats_matches_window(spark, broadcast_bytes):
    df = skewed(spark)
    keys = ["g", "k1", "k2"]
    got = flag_repeats(df, keys, "row", "rep", broadcast_bytes=broadcast_bytes)
    w = Window.partitionBy(*keys).orderBy("row")
    want = df.withColumn("rep", F.row_number().over(w) > 1)
    assert got.select("row", "rep").exceptAll(want.select("row", "rep")).count() == 0
    assert got.where("rep").count() == want.where("rep").count() > 0


def test_flag_repeats_plan_has_no_window_and_keeps_rows_in_place(spark):
    df = skewed(spark)
    plan = flag_repeats(df, ["g", "k1", "k2"], "row", "rep")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    groups_plan = __import__("lakeline.operators.quality", fromlist=["x"]).repeat_groups(
        df, ["g", "k1", "k2"], "row")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in groups_plan  # map-side combine before the shuffle


def test_source_file_filter_none_empty_list_frame(spark):
    from lakeline.operators.incremental import pending_source_files, source_file_filter

    df = spark.createDataFrame([("a", "b1"), ("b", "b1"), ("c", "b2")], "_source_file string, _batch_id string")
    assert source_file_filter(df, None).count() == 3          # first load: everything
    assert source_file_filter(df, []).count() == 0            # nothing pending: nothing
    assert source_file_filter(df, ["a", "c"]).count() == 2
    own = spark.createDataFrame([("a", "b1"), ("c", "b0")], "_source_file string, _batch_id string")
    pending = pending_source_files(df, own)                    # b new, c re-batched
    assert sorted(r[0] for r in pending.collect()) == ["b", "c"]
    assert sorted(r[0] for r in source_file_filter(df, pending).select("_source_file").collect()) == ["b", "c"]
    assert pending_source_files(df, None) is None


def test_flag_repeats_is_exact_under_hash_collisions(spark, monkeypatch):
    from lakeline.operators import quality

    # every row gets the same "hash": all rows become candidates, and the
    # exact second phase alone must decide
    monkeypatch.setattr(quality.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    df = skewed(spark, n=4000)
    keys = ["g", "k1", "k2"]
    got = quality.flag_repeats(df, keys, "row", "rep")
    want = df.withColumn("rep", F.row_number().over(Window.partitionBy(*keys).orderBy("row")) > 1)
    assert got.select("row", "rep").exceptAll(want.select("row", "rep")).count() == 0


def test_flag_repeats_groups_signed_zero_nan_and_null_like_a_window(spark):
    import itertools

    values = [0.0, -0.0, float("nan"), 1.5, None]
    rows = [(i, "f", d, k) for i, (d, k) in enumerate(itertools.product(values, [1, None])) for _ in range(1)]
    rows += [(100 + i, "f", d, k) for i, (d, k) in enumerate(itertools.product(values, [1, None]))]
    df = spark.createDataFrame(rows, "row long, unit string, d double, k int")
    keys = ["unit", "d", "k"]
    got = flag_repeats(df, keys, "row", "rep")
    want = df.withColumn("rep", F.row_number().over(Window.partitionBy(*keys).orderBy("row")) > 1)
    assert sorted(tuple(r) for r in got.select("row", "rep").collect()) == \
        sorted(tuple(r) for r in want.select("row", "rep").collect())
    assert got.where("rep").count() == want.where("rep").count() > 0


def test_flag_repeats_matches_window_on_random_tables(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    key = st.one_of(st.none(), st.integers(0, 2))
    dist = st.sampled_from([None, 0.0, -0.0, 1.25, float("nan")])
    rows = st.lists(st.tuples(st.sampled_from(["a", "b"]), key, dist), min_size=1, max_size=60)

    @settings(max_examples=6, deadline=None)
    @given(rows, st.sampled_from([None, 0]))
    def check(data, broadcast_bytes):
        df = spark.createDataFrame([(i, u, k, d) for i, (u, k, d) in enumerate(data)],
                                   "row long, unit string, k int, d double")
        keys = ["unit", "k", "d"]
        got = flag_repeats(df, keys, "row", "rep", broadcast_bytes=broadcast_bytes)
        want = df.withColumn("rep", F.row_number().over(Window.partitionBy(*keys).orderBy("row")) > 1)
        assert sorted(tuple(r) for r in got.select("row", "rep").collect()) == \
            sorted(tuple(r) for r in want.select("row", "rep").collect())

    check()


def test_position_within_matches_row_number_on_random_tables(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rows = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y"]), st.integers(0, 5)),
                    min_size=1, max_size=80)

    @settings(max_examples=5, deadline=None)
    @given(rows, st.sampled_from([2, 7]))
    def check(data, parts):
        df = spark.createDataFrame([(i, g, k) for i, (g, k) in enumerate(data)], "row long, g string, k int")
        got = position_within(df, "g", ["k", "row"], "pos", num_partitions=parts)
        want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k", "row")) - 1)
        assert sorted(tuple(r) for r in got.select("row", "pos").collect()) == \
            sorted(tuple(r) for r in want.select("row", "pos").collect())

    check()


def test_ranged_rows_are_stored_once_and_not_shuffled_again(spark):
    from lakeline.operators.positions import store_ranged

    df = skewed(spark)
    stored = store_ranged(df, "g", ["k1", "row"], 16, ["g", "row", (F.col("k1") + 1).alias("later")])
    got = stored.numbered(spark, "pos", {"of_group": F.upper("g")})
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p
    assert got.columns == ["g", "row", "later", "of_group", "pos"]
    want = df.select("g", "row", (F.col("k1") + 1).alias("later"), F.upper("g").alias("of_group"),
                     (F.row_number().over(Window.partitionBy("g").orderBy("k1", "row")) - 1).cast("long").alias("pos"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_many_repeats_are_grouped_from_the_stored_candidates(spark):
    """The input is read for the hashes, for the candidates and for the result, not a fourth time."""
    from lakeline.session import scratch_path

    path = scratch_path(spark, "repeats-input")
    skewed(spark).write.parquet(path)
    got = flag_repeats(spark.read.parquet(path), ["g", "k1", "k2"], "row", "rep", broadcast_bytes=0)
    p = got._jdf.queryExecution().executedPlan().toString()
    assert p.count("repeats-input") == 1 and p.count("repeat-candidates") == 2 and "repeat-groups" not in p
    assert "rangepartitioning(g" not in p  # few rows need one range
