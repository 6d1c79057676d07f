"""Registered queries: one Spark plan and (where SQL can say it) one oracle.

Every query reads the provided tables under ``sf_dir`` (or data Spark derives
from them) in full. Column names and types match the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeline.plans.models import TripModels, stored_models
from lakeline.plans.oracle import with_ctes
from lakeline.plans.star import star_month_borough
from lakeline.operators import quality

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Query modules register themselves on import.
    from lakeline.plans import catalog  # noqa: F401


# --- the flagship ------------------------------------------------------------

STAR_SQL = with_ctes(
    """SELECT month_name, borough, CAST(sum(n) AS BIGINT) AS trips, sum(amount) AS revenue
FROM (SELECT pickup_date_key, pickup_location_id, count(*) AS n, sum(total_amount) AS amount
      FROM fact GROUP BY ALL) zone_days, dim_date, dim_location
WHERE date_key = pickup_date_key AND location_id = pickup_location_id
GROUP BY month_name, borough""",
    "fact", "dim_date", "dim_location",
)


@register("star_month_borough", STAR_SQL)
def q_star_month_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_models(spark, sf_dir)
    return star_month_borough(m.fact, m.dim_date, m.dim_location)


@register("classify_first_match", with_ctes("SELECT * FROM classified", "classified"))
def q_classify_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TripModels(spark, sf_dir).classified


@register("reject_reason_counts", with_ctes(
    "SELECT coalesce(_reject_reason, 'valid') AS outcome, count(*) AS row_count "
    "FROM classified GROUP BY 1", "classified"))
def q_reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_reason_counts(TripModels(spark, sf_dir).classified)
