"""Gold dimensions: calendar, time of day, location and code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.config import AIRPORT_LOCATION_IDS, DAY_PARTS, OTHER_DAY_PART, RUSH_HOURS
from lakeline.functions.compat import date_key, iso_day_of_week, year_start


def calendar_bounds(silver: DataFrame) -> DataFrame:
    """One row: first day of the year of the first pickup, last day of the
    year of the last drop-off (NULLs when there are no trips)."""
    return silver.agg(
        year_start(F.min("pickup_at")).alias("first_day"),
        F.date_sub(F.add_months(year_start(F.max("dropoff_at")), 12), 1).alias("last_day"),
    )


def calendar(days: DataFrame, col: str = "calendar_date") -> DataFrame:
    """Calendar attributes of a column of dates."""
    d = F.col(col)
    dow = iso_day_of_week(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),  # 1 = Monday
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("int").alias("iso_week"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def dim_date(silver: DataFrame) -> DataFrame:
    """Every day of every calendar year that has trips.

    A global min/max (partial aggregates, one row out) expanded with
    ``sequence``; the result has at most 366 rows per year spanned.
    """
    days = calendar_bounds(silver).select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("calendar_date")
    )
    return calendar(days)


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    """The 24 hours of a day with a day-part label and a rush-hour flag."""
    h = F.col("id").cast("int")
    label = F.lpad(h.cast("string"), 2, "0")
    part = None
    for lo, hi, name in DAY_PARTS:
        cond = h.between(lo, hi)
        part = F.when(cond, F.lit(name)) if part is None else part.when(cond, F.lit(name))
    rush = None
    for lo, hi in RUSH_HOURS:
        rush = h.between(lo, hi) if rush is None else rush | h.between(lo, hi)
    return spark.range(24).select(
        h.alias("hour_of_day"),
        F.concat(label, F.lit(":00-"), label, F.lit(":59")).alias("hour_label"),
        part.otherwise(F.lit(OTHER_DAY_PART)).alias("day_part"),
        rush.alias("is_rush_hour"),
    )


def dim_location(zones: DataFrame) -> DataFrame:
    """Taxi zones with an airport flag (input: the zone lookup table)."""
    loc = F.col("location_id").cast("int")
    return zones.select(
        loc.alias("location_id"),
        F.col("borough").cast("string").alias("borough"),
        F.col("zone_name").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string").alias("service_zone"),
        loc.isin(*AIRPORT_LOCATION_IDS).alias("is_airport"),
    )


def code_list(spark: SparkSession, rows: list[tuple[int, str]], id_col: str, name_col: str) -> DataFrame:
    """A fixed (id, name) code list as a DataFrame."""
    schema = T.StructType([T.StructField(id_col, T.IntegerType(), False),
                           T.StructField(name_col, T.StringType(), False)])
    return spark.createDataFrame(rows, schema)


def complete_code_dim(known: DataFrame, facts: DataFrame, id_col: str, name_col: str,
                      unknown_prefix: str) -> DataFrame:
    """Known codes plus every code seen in ``facts`` that the list lacks.

    ``known`` is a data-dictionary list (a handful of rows) and is broadcast;
    the observed codes are a partial-aggregated distinct of one column.
    """
    known = known.select(F.col(id_col).cast("int").alias(id_col), F.col(name_col).cast("string").alias(name_col))
    observed = facts.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    unseen = observed.join(F.broadcast(known.select(id_col)), id_col, "left_anti").select(
        id_col, F.concat(F.lit(unknown_prefix), F.col(id_col).cast("string")).alias(name_col)
    )
    return known.unionByName(unseen)
