"""Consumer queries over the gold star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.compat import MONEY_SUM, sum_money


def star_month_borough(fact: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Trips and revenue per pickup month name and borough, by revenue.

    The fact side is scanned once with three columns and pre-aggregated per
    day and zone, so the joins see one row of each; whether a dimension is
    small enough to broadcast is left to the planner.
    """
    zone_days = fact.groupBy("pickup_date_key", "pickup_location_id").agg(
        F.count(F.lit(1)).alias("n"), sum_money("total_amount").alias("amount"))
    joined = (
        zone_days.join(dim_date.select("date_key", "month_name"), F.col("pickup_date_key") == F.col("date_key"))
        .join(dim_location.select("location_id", "borough"), F.col("pickup_location_id") == F.col("location_id"))
    )
    return (
        joined.groupBy("month_name", "borough")
        .agg(F.sum("n").alias("trips"), F.sum("amount").cast(MONEY_SUM).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )
