"""Replace-by-key, overwrite, append and the safety guards."""

import os

import pytest
from pyspark.sql import functions as F

from lakeline.operators import sinks


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, p string, v long")


def test_replace_by_key_keeps_untouched_keys_and_drops_stale(spark, workdir):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a/x.parquet", "1", 1), ("b", "1", 2), ("c", "2", 3), ("c", "2", 4)]),
                         path, workdir, "k", ["p"])
    # re-load a (new value), c (now empty) -> b untouched, c gone
    out = sinks.replace_by_key(frame(spark, [("a/x.parquet", "1", 10)]), path, workdir, "k", ["p"],
                               replace_keys=["a/x.parquet", "c"])
    got = sorted(tuple(r) for r in sinks.read_table(spark, path).select("k", "p", "v").collect())
    assert got == [("a/x.parquet", "1", 10), ("b", "1", 2)]
    assert out["stale_removed"] == 1


def test_replace_by_key_moves_a_key_between_partitions(spark, workdir):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a", "1", 1)]), path, workdir, "k", ["p"])
    sinks.replace_by_key(frame(spark, [("a", "2", 5)]), path, workdir, "k", ["p"])
    assert [tuple(r) for r in sinks.read_table(spark, path).select("k", "p", "v").collect()] == [("a", "2", 5)]


def test_strict_reference_leaves_rows_of_keys_without_new_rows(spark, workdir):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a", "1", 1), ("c", "1", 3)]), path, workdir, "k", ["p"])
    sinks.replace_by_key(frame(spark, [("a", "1", 9)]), path, workdir, "k", ["p"], replace_keys=["a", "c"],
                         strict_reference=True)
    assert sinks.read_table(spark, path).count() == 2


def test_empty_replace_removes_nothing_without_keys(spark, workdir):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a", "1", 1)]), path, workdir, "k", ["p"])
    sinks.replace_by_key(frame(spark, []), path, workdir, "k", ["p"])
    assert sinks.read_table(spark, path).count() == 1


def test_schema_change_is_refused(spark, workdir):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a", "1", 1)]), path, workdir, "k", ["p"])
    changed = spark.createDataFrame([("a", "1", 1.5)], "k string, p string, v double")
    with pytest.raises(sinks.SchemaChanged, match="v: table has bigint, rows have double.*--full-refresh"):
        sinks.replace_by_key(changed, path, workdir, "k", ["p"])
    assert sinks.schema_changes(frame(spark, []).schema, changed.drop("p").withColumn("w", F.lit(1)).schema) == [
        "p: table has string, rows have no column", "v: table has bigint, rows have double",
        "w: table has no column, rows have int"]


def test_overwrite_keeps_old_table_when_the_query_fails(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_table(frame(spark, [("a", "1", 1)]), path, workdir)
    bad = frame(spark, [("a", "1", 0)]).select("k", "p", (F.lit(1) / F.col("v")).cast("long").alias("v"))
    with pytest.raises(Exception):
        sinks.overwrite_table(bad, path, workdir)
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [("a", "1", 1)]
    assert os.listdir(path) == ["version-000000001"]  # no partial copy left


def test_append_puts_columns_in_table_order(spark, workdir):
    path = f"{workdir}/t"
    sinks.append_table(frame(spark, [("a", "1", 1)]), path, workdir)
    sinks.append_table(frame(spark, [("b", "2", 2)]).select("v", "p", "k"), path, workdir)
    assert sorted(tuple(r) for r in sinks.read_table(spark, path).collect()) == [("a", "1", 1), ("b", "2", 2)]


def test_paths_outside_the_root_are_refused(spark, workdir):
    with pytest.raises(ValueError, match="not strictly below"):
        sinks.overwrite_table(frame(spark, [("a", "1", 1)]), "/tmp/elsewhere-table", workdir)
    with pytest.raises(ValueError):
        sinks.delete(spark, workdir, workdir)
    with pytest.raises(ValueError):
        sinks.delete(spark, f"{workdir}/../x", workdir)
    assert os.path.isdir(workdir)


def test_partition_values_keep_their_declared_types(spark, workdir):
    path = f"{workdir}/t"
    df = spark.createDataFrame([("001", "2023-01-01", 1)], "k string, p string, v long")
    sinks.replace_by_key(df.withColumn("p", F.col("p").cast("date")), path, workdir, "k", ["p"])
    back = sinks.read_table(spark, path)
    assert dict(back.dtypes) == {"k": "string", "p": "date", "v": "bigint"}
    assert back.first()["k"] == "001"  # a numeric-looking key stays a string


def test_compaction_keeps_rows_and_schema(spark, workdir):
    path = f"{workdir}/log"
    for i in range(5):
        sinks.append_table(frame(spark, [(f"f{i}", "1", i)]).coalesce(1), path, workdir)
    assert sinks.data_file_count(spark, path) == 5
    assert not sinks.compact(spark, path, workdir, max_files=8)
    assert sinks.compact(spark, path, workdir, max_files=3)
    assert sinks.data_file_count(spark, path) == 1
    assert sorted(r.v for r in sinks.read_table(spark, path).collect()) == [0, 1, 2, 3, 4]
    sinks.append_table(frame(spark, [("f9", "1", 9)]), path, workdir)  # appends still fit the schema
    assert sinks.read_table(spark, path).count() == 6


def test_a_killed_overwrite_leaves_the_table(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    sinks.overwrite_table(frame(spark, [("a", "1", 1)]), path, workdir)
    # killed while writing: files are there, but no _SUCCESS and nobody cleans up
    monkeypatch.setattr(sinks, "delete", lambda *a: False)
    bad = frame(spark, [("a", "1", 0)]).select("k", "p", (F.lit(1) / F.col("v")).cast("long").alias("v"))
    with pytest.raises(Exception):
        sinks.overwrite_table(bad, path, workdir)
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [("a", "1", 1)]
    # killed between the new version and the removal of the old one
    sinks.overwrite_table(frame(spark, [("b", "1", 2)]), path, workdir)
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [("b", "1", 2)]
    monkeypatch.undo()
    sinks.overwrite_table(frame(spark, [("c", "1", 3)]), path, workdir, retention=sinks.Retention(0))
    assert len(os.listdir(path)) == 1
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [("c", "1", 3)]


def test_overwrites_keep_open_readers_and_stay_bounded(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_table(frame(spark, [("a", "1", 0)]), path, workdir)
    opened = sinks.read_table(spark, path)
    for i in range(1, 4):
        sinks.overwrite_table(frame(spark, [("a", "1", i)]), path, workdir)
        assert opened.first().v == 0  # opened before three overwrites
        assert sinks.read_table(spark, path).first().v == i
    for i in range(4, 8):
        sinks.overwrite_table(frame(spark, [("a", "1", i)]), path, workdir)
    assert len(os.listdir(path)) == 4  # the current version and three before it
    assert sinks.expire(spark, path, workdir, sinks.Retention(0, seconds=3600)) == 0  # all written within the hour
    assert sinks.expire(spark, path, workdir, sinks.Retention(1)) == 2
    assert sinks.read_table(spark, path).first().v == 7


def test_a_failed_first_replacement_leaves_nothing(spark, workdir):
    path = f"{workdir}/t"
    bad = frame(spark, [("a", "1", 0)]).select("k", "p", (F.lit(1) / F.col("v")).cast("long").alias("v"))
    with pytest.raises(Exception):
        sinks.replace_by_key(bad, path, workdir, "k", ["p"])
    assert not os.path.exists(path) or os.listdir(path) == []
    sinks.replace_by_key(frame(spark, [("a", "1", 1)]), path, workdir, "k", ["p"])
    assert sinks.read_table(spark, path).count() == 1


def test_what_a_killed_replacement_wrote_is_replaced_by_the_next(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    sinks.replace_by_key(frame(spark, [("a", "1", 1), ("b", "1", 2)]), path, workdir, "k", ["p"])

    def killed(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(sinks, "delete", killed)  # after the rows are written, before stale folders go
    with pytest.raises(RuntimeError, match="killed"):
        sinks.replace_by_key(frame(spark, [("a", "2", 3)]), path, workdir, "k", ["p"])
    monkeypatch.undo()
    sinks.replace_by_key(frame(spark, [("a", "3", 4)]), path, workdir, "k", ["p"])
    assert sorted(tuple(r) for r in sinks.read_table(spark, path).select("k", "p", "v").collect()) == [("a", "3", 4), ("b", "1", 2)]


def test_null_and_escaped_partition_values_are_replaced(spark, workdir):
    path = f"{workdir}/t"
    rows = [("a/x y%=1", None, 1), ("a/x y%=1", "p:1", 2), ("b", None, 3), (None, "q", 4)]
    sinks.replace_by_key(frame(spark, rows), path, workdir, "k", ["p"])
    out = sinks.replace_by_key(frame(spark, [(None, "r", 5)]), path, workdir, "k", ["p"], replace_keys=["a/x y%=1"])
    assert out["stale_removed"] == 3 and out["touched"].count() == 4
    got = sinks.read_table(spark, path).select("k", "p", "v").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("b", None, 3), (None, "r", 5)]))


def test_only_replaced_keys_are_listed_in_a_table_of_many_partitions(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    many = spark.range(5000).select((F.col("id") % 2500).cast("string").alias("k"), F.floor(F.col("id") / 2500).cast("string").alias("p"), F.col("id").alias("v"))
    sinks.overwrite_table(many.coalesce(4), path, workdir, ["p", "k"])
    keys = spark.createDataFrame([(str(k),) for k in range(10)], "k string")
    deleted = []
    real = sinks.delete
    monkeypatch.setattr(sinks, "delete", lambda s, p, r: deleted.append(p) or real(s, p, r))
    monkeypatch.setattr(sinks, "_take_inventory", lambda *a: pytest.fail("listed the whole table"))
    out = sinks.replace_by_key(many.where("v < 5").withColumn("p", F.lit("9")), path, workdir, "k", ["p"], replace_keys=keys)
    folders = [d for d in deleted if "/p=" in d]
    assert len(folders) == out["stale_removed"] == 20 and out["partitions_written"] == 5
    assert sinks.inventory(spark, path, workdir, ["p", "k"]).count() == 5000 - 20 + 5


def test_an_append_makes_the_inventory_anew(spark, workdir):
    path = f"{workdir}/t"
    sinks.overwrite_table(frame(spark, [("a", "1", 1)]), path, workdir, ["p", "k"])
    sinks.append_table(frame(spark, [("b", "2", 2)]), path, workdir, ["p", "k"])
    held = sinks.inventory(spark, path, workdir, ["p", "k"]).collect()
    assert sorted((r["k"], r["p"], r[sinks.ROWS]) for r in held) == [("a", "1", 1), ("b", "2", 1)]
    sinks.replace_by_key(frame(spark, [("b", "3", 9)]), path, workdir, "k", ["p"])
    assert sorted(r.v for r in sinks.read_table(spark, path).collect()) == [1, 9]
