"""Lookup CSVs (header row, quoted text) read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ZONE_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone_name", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with quoted fields; ``N/A`` stays a string (no null token)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ZONE_SCHEMA)


def read_codes(spark: SparkSession, path: str, id_col: str, name_col: str) -> DataFrame:
    schema = T.StructType([T.StructField(id_col, T.IntegerType()), T.StructField(name_col, T.StringType())])
    return read_csv(spark, path, schema)
