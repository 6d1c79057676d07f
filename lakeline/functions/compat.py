"""Column helpers that reproduce the pipeline's SQL semantics bit for bit.

Every helper is a pure ``Column -> Column`` expression built from
``pyspark.sql.functions``, so it stays inside whole-stage codegen.
The rules behind them:

* double -> integer rounds half to even (``rint`` before the cast);
* double -> decimal and ``round(x, 2)`` scale in binary first, then round
  half away from zero (``round(x * 100D, 0) / 100D``), so 1.005 -> 1.00;
* second differences count boundaries (floor of each side), not elapsed
  whole seconds;
* integer / literal divisions happen in double, never in decimal;
* calendar helpers work on ``timestamp_ntz`` wall-clock values and never go
  through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(10, 2)
MONEY_SUM = DecimalType(38, 2)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int(col: str | Column) -> Column:
    """``double::integer``: round half to even, then cast (overflow raises)."""
    return F.rint(_c(col)).cast("int")


def round_half_away(col: str | Column) -> Column:
    """Round a double to an integral double, ties away from zero.

    ``rint`` rounds ties to even; a tie is exactly ``|y - rint(y)| = 0.5``
    (that difference is exact), and where ``rint`` went toward zero the
    result moves one step away. Pure double arithmetic: no BigDecimal per
    value, unlike ``round``; NaN and infinities pass through.
    """
    y = _c(col)
    r = F.rint(y)
    toward_zero_tie = (F.abs(y - r) == F.lit(0.5)) & (F.abs(r) < F.abs(y))
    return F.when(toward_zero_tie, r + F.signum(y)).otherwise(r)


def round2(col: str | Column) -> Column:
    """``round(double, 2)`` with binary scaling and half-away-from-zero ties."""
    return round_half_away(_c(col) * F.lit(100.0)) / F.lit(100.0)


def to_money(col: str | Column) -> Column:
    """``double::decimal(10, 2)``; values beyond 10^8 raise, as they should."""
    return round2(col).cast(MONEY)


def round2_decimal(col: str | Column) -> Column:
    """``round(double, 2)::decimal(10, 2)``."""
    return to_money(col)


def epoch_seconds(col: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock timestamp.

    Built from the date and the time-of-day fields, so it does not depend on
    ``spark.sql.session.timeZone`` (a cast to ``timestamp`` would).
    """
    c = _c(col)
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(86400)
        + F.hour(c) * F.lit(3600)
        + F.minute(c) * F.lit(60)
        + F.second(c).cast("long")
    )


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``date_diff('second', start, end)``: second boundaries crossed."""
    return epoch_seconds(end) - epoch_seconds(start)


def month_start(col: str | Column) -> Column:
    """First day of the month of a timestamp or date, as a DATE."""
    return F.trunc(F.to_date(_c(col)), "month")


def year_start(col: str | Column) -> Column:
    return F.trunc(F.to_date(_c(col)), "year")


def date_key(col: str | Column) -> Column:
    """``strftime(x, '%Y%m%d')::integer`` without formatting a string."""
    d = F.to_date(_c(col))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(col: str | Column) -> Column:
    """``isodow``: 1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(col)) + 1).cast("int")


def sum_money(col: str | Column) -> Column:
    """``sum(decimal(10,2))`` typed as the SQL engine types it: decimal(38,2)."""
    return F.sum(_c(col)).cast(MONEY_SUM)
