"""Date dimension (one row per day) and its week-ending helper."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions import day_of_week0, month_abbr
from stockroom.operators.conform import conform
from stockroom.plans.schemas import DATE_DIM

YEARS_BACK = 4
YEARS_FORWARD = 1


def _add_years(d: dt.date, years: int) -> dt.date:
    y = d.year + years
    return d.replace(year=y, day=min(d.day, calendar.monthrange(y, d.month)[1]))


def spine_bounds(as_of: dt.date, years_back: int = YEARS_BACK, years_forward: int = YEARS_FORWARD):
    """(first day, last day, day count): the range ends ``years_forward`` years
    after ``as_of`` and reaches back ``dayofyear(as_of) + 365 * years_back`` days."""
    last = _add_years(as_of, years_forward)
    n = as_of.timetuple().tm_yday + 365 * years_back
    return last - dt.timedelta(days=n - 1), last, n



def _with_attributes(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return conform(
        days.select(
            d,
            F.year(d),
            F.month(d),
            month_abbr(d),
            F.dayofmonth(d),
            day_of_week0(d),
            F.weekofyear(d),
            F.dayofyear(d),
        ),
        DATE_DIM,
    )


def date_dim(
    spark: SparkSession,
    as_of: dt.date | None = None,
    years_back: int = YEARS_BACK,
    years_forward: int = YEARS_FORWARD,
) -> DataFrame:
    """Calendar for a run on ``as_of`` (default: the session's current date)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return date_dim_for_anchor(spark.range(1).select(today.alias("as_of")), "as_of", years_back, years_forward)


def date_dim_for_anchor(
    anchor: DataFrame, as_of_col: str = "as_of", years_back: int = YEARS_BACK, years_forward: int = YEARS_FORWARD
) -> DataFrame:
    """Calendar whose run date is read from a one-row frame (e.g. the latest
    day present in the landed data), evaluated lazily by Spark.  At most 366 +
    365 * ``years_back`` rows."""
    a = F.col(as_of_col)
    last = F.add_months(a, 12 * years_forward)
    first = F.date_sub(last, F.dayofyear(a) + 365 * years_back - 1)
    days = anchor.select(F.explode(F.sequence(first, last)).alias("date"))
    return _with_attributes(days)
