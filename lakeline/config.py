"""Contracts, thresholds and fixed lookup values of the trip pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: landing contract (column name, type) in file order -------
BRONZE_CONTRACT: list[tuple[str, T.DataType]] = [
    ("vendorid", T.LongType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("ratecodeid", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pulocationid", T.LongType()),
    ("dolocationid", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
]

# Lineage columns appended by the bronze load, in table order.
LINEAGE_COLUMNS = [
    "_source_file",
    "_source_row_number",
    "_source_modified_at",
    "_source_period",
    "_batch_id",
    "_ingested_at",
]

# --- fixed values: file-name pattern giving the file's year and month -------
SOURCE_PERIOD_PATTERN = r"(\d{4})[_-](\d{2})\.parquet$"

# --- fixed values: keys that make two rows of one file the same trip --------
DEDUP_KEYS = [
    "_source_file",
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance_miles",
    "fare_amount",
    "total_amount",
    "payment_type_id",
]

# --- fixed values: rejection reasons, in the order the rules are tried ------
REJECT_REASONS = [
    "duplicate",
    "unknown_source_period",
    "missing_timestamp",
    "pickup_outside_file_month",
    "invalid_duration",
    "invalid_distance",
    "implausible_speed",
    "invalid_amount",
    "unknown_location",
]

# --- fixed values: valid taxi-zone id range and airport zones ---------------
MIN_LOCATION_ID = 1
MAX_LOCATION_ID = 265
AIRPORT_LOCATION_IDS = (1, 132, 138)  # Newark, JFK, LaGuardia

# --- fixed values: data-dictionary code lists (id, name) --------------------
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
UNKNOWN_RATE_CODE = 99

# --- fixed values: day parts of dim_time_of_day (first hour, last hour, label)
DAY_PARTS = [
    (0, 5, "Late night"),
    (6, 9, "Morning rush"),
    (10, 15, "Midday"),
    (16, 19, "Evening rush"),
]
OTHER_DAY_PART = "Evening"
RUSH_HOURS = [(6, 9), (16, 19)]


@dataclass(frozen=True)
class Thresholds:
    """Silver cleaning thresholds (defaults are the pipeline's defaults)."""

    min_trip_duration_minutes: float = 1
    max_trip_duration_hours: float = 6
    max_trip_distance_miles: float = 500
    max_avg_speed_mph: float = 80
    max_fare_amount: float = 2000


DEFAULT_THRESHOLDS = Thresholds()


def bronze_schema() -> T.StructType:
    """Typed schema of the conformed landing columns (no lineage)."""
    return T.StructType([T.StructField(n, t, True) for n, t in BRONZE_CONTRACT])
