"""Column-level helpers (pure ``pyspark.sql.functions`` expressions)."""

from lakeline.functions.compat import (  # noqa: F401
    MONEY,
    MONEY_SUM,
    date_key,
    epoch_seconds,
    iso_day_of_week,
    month_start,
    round2,
    round2_decimal,
    seconds_between,
    sum_money,
    to_int,
    to_money,
    year_start,
)
