"""The model graph over the provided tables: bronze -> silver -> gold.

``TripModels(spark, sf_dir)`` builds every layer lazily from ``lineitem``
(bronze-shaped trips, see :mod:`lakeline.sources.fixture`) and
``nation``/``region`` (taxi zones). Each attribute is a DataFrame plan. The same operators run on real landing files through
:mod:`lakeline.plans.pipeline`. Two attributes write small tables below the
checkpoint folder when first used: the bronze trips, and the sets of repeated
keys that the classification needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeline.config import (
    AIRPORT_LOCATION_IDS,
    DEFAULT_THRESHOLDS,
    MAX_LOCATION_ID,
    MIN_LOCATION_ID,
    PAYMENT_TYPES,
    RATE_CODES,
    VENDORS,
    Thresholds,
)
from lakeline.operators import dims, facts, quality
from lakeline.session import compile_wide_rows, scratch_path
from lakeline.sources.fixture import _input_version, read_table, trips_bronze_table

# (application id, sf_dir, lineitem version, thresholds) -> folder and schema of each stored layer
_STORED: dict[tuple, dict[str, tuple[str, StructType]]] = {}


def zones_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxi-zone lookup (ids 1..265) derived from ``nation`` and ``region``.

    Zone ``id`` takes the name of nation ``id % 25`` and the borough of that
    nation's region; airports get the ``Airports`` service zone.
    """
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    ids = spark.range(MIN_LOCATION_ID, MAX_LOCATION_ID + 1).select(F.col("id").cast("int").alias("location_id"))
    # nation (25 rows) and region (5 rows) are fixed-size tables
    named = ids.join(F.broadcast(nation), (F.col("location_id") % 25) == F.col("n_nationkey")).join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(
        "location_id",
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
        F.when(F.col("location_id").isin(*AIRPORT_LOCATION_IDS), F.lit("Airports"))
        .otherwise(F.lit("Boro Zone")).alias("service_zone"),
    )


def zones_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone lookup with one zone per customer (it grows with the data).

    Zone ``c_custkey`` is named after the customer, lies in the borough of the
    customer's region and in the customer's market segment as service zone.
    """
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size tables
    return (
        customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").cast("int").alias("location_id"), F.col("r_name").alias("borough"),
                F.col("c_name").alias("zone_name"), F.col("c_mktsegment").alias("service_zone"))
    )


class TripModels:
    """Lazily built layers of the trip star schema."""

    def __init__(self, spark: SparkSession, sf_dir: str, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                 **tables: DataFrame):
        """``tables`` replaces layers by already built ones (e.g. written
        tables read back: ``bronze=..., silver=..., fact=...``)."""
        compile_wide_rows(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.thresholds = thresholds
        for name, df in tables.items():
            if not isinstance(getattr(type(self), name, None), cached_property):
                raise ValueError(f"unknown layer {name!r}")
            self.__dict__[name] = df

    @cached_property
    def bronze(self) -> DataFrame:
        return trips_bronze_table(self.spark, self.sf_dir)

    @cached_property
    def typed(self) -> DataFrame:
        return quality.typed_trips(self.bronze)

    @cached_property
    def classified(self) -> DataFrame:
        return quality.classify(self.bronze, self.thresholds)

    @cached_property
    def silver(self) -> DataFrame:
        return quality.silver_valid(self.classified)

    @cached_property
    def rejected(self) -> DataFrame:
        return quality.silver_rejected(self.classified)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_trips(self.silver)

    @cached_property
    def daily_zone_summary(self) -> DataFrame:
        return facts.fact_daily_zone_summary(self.fact)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.silver)

    @cached_property
    def dim_time_of_day(self) -> DataFrame:
        return dims.dim_time_of_day(self.spark)

    @cached_property
    def zones(self) -> DataFrame:
        return zones_from_tables(self.spark, self.sf_dir)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dims.dim_location(self.zones)

    def known_codes(self, which: str) -> DataFrame:
        rows, id_col, name_col = {
            "vendor": (VENDORS, "vendor_id", "vendor_name"),
            "rate_code": (RATE_CODES, "rate_code_id", "rate_code_name"),
            "payment_type": (PAYMENT_TYPES, "payment_type_id", "payment_type_name"),
        }[which]
        return dims.code_list(self.spark, rows, id_col, name_col)

    def _code_dim(self, which: str) -> DataFrame:
        return dims.complete_code_dim(self.known_codes(which), self.silver, f"{which}_id", f"{which}_name",
                                      f"Unknown {which.replace('_', ' ')} ")

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return self._code_dim("vendor")

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return self._code_dim("rate_code")

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return self._code_dim("payment_type")


class StoredTripModels(TripModels):
    """Models whose layers are stored tables, each written when it is first used.

    The classification is written once as one table with both silver halves, fact is
    projected from the stored silver, and summary and dimensions are stored tables built
    from those two, so a query on gold reads gold tables only, and a query on silver
    does not wait for gold.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, thresholds: Thresholds, schemas: dict[str, tuple[str, StructType]]):
        super().__init__(spark, sf_dir, thresholds)
        self._schemas = schemas  # layer -> folder and schema

    def _stored(self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        if name not in self._schemas:
            layer, path = build(), scratch_path(self.spark, f"trips-{name}")
            out = layer.write.option("compression", "zstd")
            (out.partitionBy(partition_by) if partition_by else out).parquet(path)
            self._schemas[name] = path, layer.schema
        path, schema = self._schemas[name]
        return self.spark.read.schema(schema).parquet(path)

    @cached_property
    def _halves(self) -> DataFrame:
        with _open_halves(self.spark):
            return self._stored("halves", lambda: quality.both_halves(self.classified), "half")

    @cached_property
    def silver(self) -> DataFrame:
        return self._halves.where(F.col("half") == "valid").select(*quality.SILVER_COLUMNS)

    @cached_property
    def rejected(self) -> DataFrame:
        return self._halves.where(F.col("half") == "rejected").select(*quality.REJECTED_COLUMNS)

    @cached_property
    def fact(self) -> DataFrame:
        return self._stored("fact", lambda: facts.fact_trips(self.silver))

    @cached_property
    def daily_zone_summary(self) -> DataFrame:
        return self._stored("daily_zone_summary", lambda: facts.fact_daily_zone_summary(self.fact))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stored("dim_date", lambda: dims.dim_date(self.silver))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._stored("dim_location", lambda: dims.dim_location(self.zones))

    def _stored_code_dim(self, which: str) -> DataFrame:
        return self._stored(f"dim_{which}", lambda: self._code_dim(which))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return self._stored_code_dim("vendor")

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return self._stored_code_dim("rate_code")

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return self._stored_code_dim("payment_type")


@contextmanager
def _open_halves(spark: SparkSession) -> Iterator[None]:
    """Tasks keep a file open for each half instead of sorting their rows by it (as they
    would from as many open files on as the setting says)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "4")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def stored_models(spark: SparkSession, sf_dir: str, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> TripModels:
    """Models whose layers are stored tables, as in the pipeline.

    A layer is written below the shared checkpoint folder when it is first used and
    read by all later models of the session over the same input.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _input_version(spark, sf_dir), thresholds)
    return StoredTripModels(spark, sf_dir, thresholds, _STORED.setdefault(key, {}))
