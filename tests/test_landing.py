"""Landing files: listing, drift conforming, lineage under split reads, periods."""

import os
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landing_files import month_rows, write
from lakeline.sources import landing


def test_listing_matches_reader_paths_and_mtimes(spark, workdir):
    path = write(f"{workdir}/l/trips_2023_01.parquet", month_rows("2023-01"), mtime=1_700_000_000)
    listed = landing.list_landing(spark, f"{workdir}/l/*.parquet").collect()
    read = landing.read_landing(spark, [listed[0][0]]).select("_source_file", "_source_modified_at").first()
    assert len(listed) == 1 and listed[0][0].endswith(path) and listed[0][0].startswith("file:")
    assert tuple(listed[0]) == tuple(read)


def test_listing_of_empty_glob_is_empty(spark, workdir):
    assert landing.list_landing(spark, f"{workdir}/none/*.parquet").count() == 0


def test_drifted_files_conform_to_contract(spark, workdir):
    a = write(f"{workdir}/l/trips_2023_01.parquet", month_rows("2023-01", n=5, bad=False))
    b = write(f"{workdir}/l/trips_2023-02.parquet", month_rows("2023-02", n=4, bad=False),
              overrides={"VendorID": pa.int32(), "passenger_count": pa.int64(), "trip_distance": pa.float32()},
              rename={"airport_fee": "Airport_fee", "VendorID": "vendorID"}, drop=("congestion_surcharge",))
    c = write(f"{workdir}/l/misc.parquet", month_rows("2023-03", n=3, bad=False),
              overrides={"PULocationID": pa.int32()})
    df = landing.read_landing(spark, [a, b, c])
    assert [f.name for f in df.schema.fields][:19] == [n for n, _ in landing.BRONZE_CONTRACT]
    assert dict(df.dtypes)["vendorid"] == "bigint" and dict(df.dtypes)["passenger_count"] == "double"
    by_file = {os.path.basename(r[0]): (r[1], r[2]) for r in
               df.groupBy("_source_file", "_source_period").count().select("_source_file", "_source_period", "count").collect()}
    assert {k: (str(v[0]), v[1]) for k, v in by_file.items()} == {
        "trips_2023_01.parquet": ("2023-01-01", 5), "trips_2023-02.parquet": ("2023-02-01", 4),
        "misc.parquet": ("None", 3)}
    feb = df.where(F.col("_source_file").endswith("trips_2023-02.parquet"))
    assert feb.where(F.col("congestion_surcharge").isNotNull()).count() == 0
    assert feb.where(F.col("airport_fee").isNull()).count() == 0


def test_row_numbers_exact_when_a_file_is_split(spark, workdir):
    n = 60000
    rows = [dict(r, extra=float(i)) for i, r in enumerate(month_rows("2023-05", n=n, bad=False))]
    path = write(f"{workdir}/big/trips_2023_05.parquet", rows, row_group_size=2000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = landing.read_landing(spark, [path])
        assert df.rdd.getNumPartitions() > 4
        bad = df.where(F.col("_source_row_number") != F.col("extra").cast("long")).count()
        assert bad == 0 and df.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_source_period_edge_cases(spark):
    names = ["a/yellow_tripdata_2023_01.parquet", "a/yellow_tripdata_2023-12.parquet", "a/misc.parquet",
             "a/yellow_tripdata_2023_13.parquet", "a/yellow_tripdata_2023_00.parquet",
             "a/yellow_tripdata_202301.parquet", "a/trips_2023_01.parquet.bak"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [None if r[0] is None else str(r[0]) for r in df.coalesce(1).select(landing.source_period("p")).collect()]
    assert got == ["2023-01-01", "2023-12-01", None, None, None, None, None]


def test_glob_classes_narrow_a_run(spark, workdir):
    for m in ("01", "02", "03"):
        write(f"{workdir}/g/trips_2023_{m}.parquet", month_rows(f"2023-{m}", n=2, bad=False))
    df = landing.list_landing(spark, f"{workdir}/g/trips_2023_0[12].parquet")
    assert sorted(os.path.basename(r[0]) for r in df.collect()) == ["trips_2023_01.parquet", "trips_2023_02.parquet"]


def test_footers_group_drifted_files(spark, workdir):
    write(f"{workdir}/f/trips_2023_01.parquet", month_rows("2023-01", n=3, bad=False))
    write(f"{workdir}/f/trips_2023_02.parquet", month_rows("2023-02", n=3, bad=False), overrides={"VendorID": pa.int32()})
    write(f"{workdir}/f/trips_2023_03.parquet", month_rows("2023-03", n=3, bad=False))
    files = [r[0] for r in landing.list_landing(spark, f"{workdir}/f/*.parquet").collect()]
    found = landing.footer_signatures(spark, files)
    assert sorted(found) == sorted(files) and len(set(found.values())) == 2  # the int32 file is a group of its own


@pytest.mark.parametrize("files", [2, 520])
def test_a_scheme_that_only_spark_opens(spark, workdir, files):
    """viewfs is a Hadoop file system: pyarrow cannot open it, at no number of files."""
    first = write(f"{workdir}/v/part0_2023_01.parquet", month_rows("2023-01", n=2, bad=False))
    for i in range(1, files):
        shutil.copy(first, f"{workdir}/v/part{i}_2023_01.parquet")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.landing{files}.link./in", f"file://{workdir}/v")
    listed = [r[0] for r in landing.list_landing(spark, f"viewfs://landing{files}/in/*.parquet").collect()]
    assert len(listed) == files and all(f.startswith(f"viewfs://landing{files}/in/") for f in listed)
    got = landing.read_landing(spark, listed).groupBy("_source_file").count().collect()
    assert {r[0] for r in got} == set(listed) and {r[1] for r in got} == {2}


def test_names_that_uris_escape(spark, workdir):
    names = ["trips feb_2023_02.parquet", "trips%20feb_2023_03.parquet", "trips#1_2023_04.parquet", "a+b_2023_05.parquet",
             "t[1]{x}*?_2023_06.parquet", "é_2023_07.parquet"]
    for n in names:
        write(f"{workdir}/u/{n}", month_rows("2023-02", n=2, bad=False))
    listed = landing.list_landing(spark, f"{workdir}/u/*.parquet")
    read = landing.read_landing(spark, [r[0] for r in listed.collect()])
    assert {os.path.basename(r[0]) for r in listed.collect()} == set(names)
    assert read.join(listed, ["_source_file", "_source_modified_at"]).count() == read.count() == 2 * len(names)
    assert read.where(F.col("_source_period").isNull()).count() == 0


def test_drifted_doubles_round_and_zoned_times_become_utc(spark, workdir):
    rows = [dict(r, VendorID=v) for r, v in zip(month_rows("2023-01", n=4, bad=False), [0.5, 1.5, 2.5, -3.7])]
    path = write(f"{workdir}/d/trips_2023_01.parquet", rows,
                 overrides={"VendorID": pa.float64(), "tpep_pickup_datetime": pa.timestamp("us", tz="UTC")})
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = landing.read_landing(spark, [path]).orderBy("_source_row_number").select(
            "vendorid", F.col("tpep_pickup_datetime").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in got] == [0, 2, 2, -4]
    assert [r[1] for r in got] == [f"{r['tpep_pickup_datetime']}" for r in rows]


def test_listing_is_a_scan_without_bodies(spark, workdir):
    for m in ("01", "02"):
        write(f"{workdir}/s/trips_2023_{m}.parquet", month_rows(f"2023-{m}", n=2, bad=False))
    write(f"{workdir}/s/folder.parquet/part-0.parquet", month_rows("2023-03", n=2, bad=False))  # a folder that matches
    write(f"{workdir}/s/_hidden_2023_04.parquet", month_rows("2023-04", n=2, bad=False))
    listed = landing.list_landing(spark, f"{workdir}/s/*.parquet")
    assert sorted(os.path.basename(r[0]) for r in listed.collect()) == ["trips_2023_01.parquet", "trips_2023_02.parquet"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in plan and "content" not in plan.split("ReadSchema")[1]
    empty = landing.list_landing(spark, f"{workdir}/s/none_[0-9].parquet")
    assert empty.schema == landing.LISTING_SCHEMA and empty.isEmpty()


@pytest.mark.parametrize("glob, names", [
    ("*.parquet", ["a_1.parquet", "a_2.parquet", "b_1.parquet", "a[1].parquet", "x+y.parquet"]),
    ("a_[12].parquet", ["a_1.parquet", "a_2.parquet"]), ("a_[^1].parquet", ["a_2.parquet"]),
    ("{a_2,b_?}.parquet", ["a_2.parquet", "b_1.parquet"]), ("a\\[1\\].parquet", ["a[1].parquet"]),
    ("x+y.parquet", ["x+y.parquet"]), ("[b-z]*.parquet", ["b_1.parquet", "x+y.parquet"]), ("a_1", []),
])
def test_globs_as_a_filter(spark, workdir, glob, names):
    every = ["a_1.parquet", "a_2.parquet", "b_1.parquet", "a[1].parquet", "x+y.parquet"]
    listing = spark.createDataFrame([(f"file:/l/{n}", None) for n in every], landing.LISTING_SCHEMA)
    assert sorted(os.path.basename(r[0]) for r in landing.matching(listing, glob).collect()) == sorted(names)
    for n in every:
        with open(f"{workdir}/{n}", "w") as f:
            f.write("x")
    listed = landing.list_landing(spark, f"{workdir}/{glob}")  # the file system's own reading of the glob
    assert sorted(os.path.basename(r[0]) for r in listed.collect()) == sorted(names)
