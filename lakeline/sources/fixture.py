"""A bronze-shaped trips table derived from ``lineitem``.

The raw trip files are not available offline, so every query that needs
bronze rows builds them from the provided ``lineitem`` table with one fixed
mapping (kept identical in :mod:`lakeline.plans.oracle`). Each line item
becomes a trip; line items of every 50th order appear twice, which gives
exact duplicates; a few formulas push rows into each rejection rule.

Row positions inside a "file" follow a fixed total order and are computed
by ranges (:mod:`lakeline.operators.positions`), so a file that holds most rows is
still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.config import BRONZE_CONTRACT
from lakeline.operators.positions import Ranged, store_ranged
from lakeline.sources.landing import source_period

# (application id, sf_dir, lineitem mtime) -> the written bronze rows
_MATERIALIZED: dict[tuple, Ranged] = {}

ROWS_PER_RANGE = 1 << 18  # sorted in memory by one task

LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _landing_name() -> F.Column:
    ship_day = F.to_date("l_shipdate")
    named_day = F.when(F.col("l_partkey") % 97 == 0, F.date_sub(ship_day, 40)).otherwise(ship_day)
    return (
        F.when(F.col("l_partkey") % 101 == 0, F.lit("landing/misc.parquet"))
        .otherwise(F.concat(F.lit("landing/trips_"), F.date_format(named_day, "yyyy_MM"), F.lit(".parquet")))
    )


def _store_trips(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> Ranged:
    """The trips' rows in file order, shuffled once as line items and stored as trips."""
    table = read_table(spark, sf_dir, "lineitem")
    n = num_partitions or max(spark.sparkContext.defaultParallelism, -(-table.count() // ROWS_PER_RANGE))
    # the physical row spreads many identical line items over ranges; any order among them
    # gives the same trips
    li = table.select(*LINEITEM_ORDER, F.col("_metadata.row_index").alias("_li_row"))
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    li = li.withColumn("copy", F.explode(copies)).withColumn("_source_file", _landing_name())

    ship = F.col("l_shipdate")
    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    start_secs = (pk % 1440) * 60
    ride_secs = ((F.col("l_quantity") - 1) * 75 * F.col("l_linenumber")).cast("long")
    fare = price / F.lit(50.0)
    tip = disc * F.lit(10.0)
    trips = [
        (F.col("l_suppkey") % 8).alias("vendorid"),
        F.when(pk % 89 == 0, F.lit(None)).otherwise(F.timestamp_add("SECOND", start_secs, ship))
        .cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", start_secs + ride_secs, ship).cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.when(pk % 20 == 0, F.lit(None)).otherwise(F.col("l_linenumber")).cast("double").alias("passenger_count"),
        F.when(pk % 83 == 0, F.lit(600.0)).otherwise(price * disc / F.lit(200.0)).alias("trip_distance"),
        F.when(pk % 9 == 0, F.lit(None)).otherwise(pk % 9).cast("double").alias("ratecodeid"),
        F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        (pk % 270).alias("pulocationid"),
        (ok % 266).alias("dolocationid"),
        (ok % 8).alias("payment_type"),
        F.when((F.col("l_returnflag") == "R") & (tax >= 0.07), -fare).otherwise(fare).alias("fare_amount"),
        tax.alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.when(tip == 0, F.lit(None)).otherwise(tip).alias("tip_amount"),
        F.lit(None).cast("double").alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (price * (F.lit(1.0) + tax) / F.lit(50.0)).alias("total_amount"),
        F.lit(None).cast("double").alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("airport_fee"),
        F.col("_source_file"),
    ]
    return store_ranged(li, "_source_file", [*LINEITEM_ORDER, "copy", "_li_row"], n, trips, "trips-bronze")


def _stored_trips(spark: SparkSession, stored: Ranged) -> DataFrame:
    """The contract columns as stored, lineage from the file's name once for each file and range."""
    period = source_period("_source_file")
    return stored.numbered(spark, "_source_row_number", {
        "_source_modified_at": F.coalesce(F.add_months(period, 1), F.lit("2002-01-01").cast("date")).cast("timestamp_ntz"),
        "_source_period": period,
        "_batch_id": F.concat(F.lit("batch-"), (F.coalesce(F.month(period), F.lit(0)) % 3).cast("string")),
    }).select(*[n for n, _ in BRONZE_CONTRACT],
              "_source_file", "_source_row_number", "_source_modified_at", "_source_period", "_batch_id")


def trips_bronze(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> DataFrame:
    """Bronze-shaped trips (contract columns + deterministic lineage)."""
    return _stored_trips(spark, _store_trips(spark, sf_dir, num_partitions))


def _input_version(spark: SparkSession, sf_dir: str) -> str:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.getFileStatus(path)
    return f"{st.getModificationTime()}:{st.getLen()}"


def trips_bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze trips written once per session as Parquet and read back.

    Bronze is a stored table in the pipeline, and every layer below reads it
    with column pruning; this does the same for the derived trips. The copy
    lives in the shared checkpoint folder and is rebuilt when ``lineitem``
    changes or the application restarts.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _input_version(spark, sf_dir))
    if key not in _MATERIALIZED:
        _MATERIALIZED[key] = _store_trips(spark, sf_dir)
    return _stored_trips(spark, _MATERIALIZED[key])


def drifted_deliveries(bronze: DataFrame, lineage: bool = True) -> list[DataFrame]:
    """The bronze rows as three deliveries with drifted schemas.

    Even months: mixed-case names, 32-bit ids. Odd months: 64-bit passenger
    count, no airport fee. No month (misc file): an extra column. With
    ``lineage`` the file name and row number are kept.
    """
    month = F.month("_source_period")
    raw = [c for c in bronze.columns if not c.startswith("_")]
    keep = raw + (["_source_file", "_source_row_number"] if lineage else ["_source_file"])
    base = bronze.select(*keep, "_source_period")
    renamed = {"vendorid": "VendorID", "pulocationid": "PULocationID", "airport_fee": "Airport_fee"}
    even = base.where(month % 2 == 0).select(*[
        (F.col(c).cast("int") if c in ("vendorid", "pulocationid") else F.col(c)).alias(renamed.get(c, c))
        for c in keep])
    odd = base.where(month % 2 == 1).select(*[
        F.col(c).cast("long") if c == "passenger_count" else F.col(c) for c in keep if c != "airport_fee"])
    none = base.where(month.isNull()).select(*keep, F.lit("x").alias("unexpected_column"))
    return [even, odd, none]


def write_landing(spark: SparkSession, bronze: DataFrame, folder: str, one_file_per_name: bool = False) -> str:
    """Write ``bronze`` back out as landing files; return their glob.

    Each delivery is written by Spark, partitioned by the landing name; every
    part file is then renamed to ``<folder>/<delivery>-<part>/<landing name>``
    so file names carry the period as real landing files do. A month is
    spread over several files (one per writing task). ``one_file_per_name``
    writes exactly one file per month, as a provider delivers them; it routes
    a whole month through one task and is meant for preparing small
    benchmark inputs only.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for i, frame in enumerate(drifted_deliveries(bronze, lineage=False)):
        tmp = f"{folder}/_write{i}"
        name = F.regexp_extract("_source_file", r"([^/]+)$", 1)
        out = frame.withColumn("_landing", name).drop("_source_file")
        if one_file_per_name:
            out = out.repartition("_landing")
        out.write.partitionBy("_landing").parquet(tmp)
        root = jvm.org.apache.hadoop.fs.Path(tmp)
        fs = root.getFileSystem(conf)
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{tmp}/_landing=*/part-*.parquet")) or []:
            src = st.getPath()
            landing_name = src.getParent().getName().split("=", 1)[1]
            part = src.getName().split("-")[1]
            dst = jvm.org.apache.hadoop.fs.Path(f"{folder}/d{i}-{part}/{landing_name}")
            fs.mkdirs(dst.getParent())
            fs.rename(src, dst)
        fs.delete(root, True)
    return f"{folder}/*/*.parquet"
