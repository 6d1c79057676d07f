"""Gold facts: the trip fact and the daily per-zone summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.compat import date_key, round2, sum_money

MONEY_COLUMNS = [
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "total_amount",
]


def fact_trips(silver: DataFrame) -> DataFrame:
    """One row per valid trip with date/hour keys, average speed and tip share.

    A narrow projection of silver: no joins, no shuffle.
    """
    minutes = F.col("trip_duration_minutes").cast("double")
    tip_share = F.col("tip_amount").cast("double") / F.col("fare_amount").cast("double") * F.lit(100.0)
    return silver.select(
        "trip_id",
        date_key("pickup_at").alias("pickup_date_key"),
        date_key("dropoff_at").alias("dropoff_date_key"),
        F.hour("pickup_at").cast("int").alias("pickup_hour_of_day"),
        "pickup_location_id",
        "dropoff_location_id",
        "vendor_id",
        "rate_code_id",
        "payment_type_id",
        "pickup_at",
        "dropoff_at",
        "passenger_count",
        "trip_distance_miles",
        "trip_duration_minutes",
        # the speed uses the rounded minutes, as the model does
        round2(F.try_divide(F.col("trip_distance_miles"), minutes / F.lit(60.0))).alias("avg_speed_mph"),
        *MONEY_COLUMNS,
        # cash tips never reach the meter, so only card trips have a share
        F.when(F.col("payment_type_id") == 1, round2(tip_share)).alias("tip_percentage"),
        "_source_file",
        "_batch_id",
    )


def fact_daily_zone_summary(fact: DataFrame) -> DataFrame:
    """Trips, passengers, distance and money per pickup day and pickup zone.

    One hash aggregate; partial aggregation combines a hot zone on the map
    side before the shuffle. Sums are exact (decimals, and distances as whole
    units of 1e-7 mile), so the averages do not depend on the order of adding.
    """
    ticks = F.sum(F.rint(F.col("trip_distance_miles") * F.lit(1e7)).cast("long")).cast("double") / F.lit(1e7)
    trips = F.count(F.lit(1))
    return fact.groupBy(
        F.col("pickup_date_key").alias("date_key"),
        F.col("pickup_location_id").alias("location_id"),
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("passenger_count").cast("long").alias("passenger_count"),
        round2(ticks).alias("trip_distance_miles"),
        sum_money("fare_amount").alias("fare_amount"),
        sum_money("tip_amount").alias("tip_amount"),
        sum_money("total_amount").alias("total_amount"),
        round2(ticks / trips).alias("avg_trip_distance_miles"),
        round2(F.sum("trip_duration_minutes").cast("double") / trips).alias("avg_trip_duration_minutes"),
        round2(F.sum("total_amount").cast("double") / trips).alias("avg_total_amount"),
        F.count_if(F.col("payment_type_id") == 1).alias("card_trip_count"),
        F.count_if(F.col("payment_type_id") == 2).alias("cash_trip_count"),
    )
