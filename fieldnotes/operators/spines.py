"""Integer, day and month spines.

The models' spines run from the epoch to the run's horizon, so their sizes depend on
parameters only. A spine over a log runs from the log's first day to the horizon past
its last load; its bounds are one aggregated row, read from the log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.params import Params


def numbers_spine(spark: SparkSession, params: Params) -> DataFrame:
    """0 .. (days from epoch to as_of) + horizon, inclusive."""
    return spark.range(0, params.spine_days).select(F.col("id").cast("int").alias("numbers"))


def dates_spine(spark: SparkSession, params: Params) -> DataFrame:
    """One DATE per day from the epoch to as_of + horizon."""
    return numbers_spine(spark, params).select(
        F.date_add(F.lit(params.epoch), F.col("numbers")).alias("date_day")
    )


def month_count(first: dt.date, last: dt.date) -> int:
    return (last.year - first.year) * 12 + last.month - first.month + 1


def months_spine(spark: SparkSession, params: Params) -> DataFrame:
    """Distinct month starts of the day spine, as TIMESTAMP_NTZ.

    The day spine is contiguous, so its distinct months are every month from
    the first day's month to the last day's month; generating them directly
    gives the same rows without a distinct (and its shuffle).
    """
    first = params.epoch.replace(day=1)
    n = month_count(first, params.spine_end)
    return spark.range(0, n).select(
        F.add_months(F.lit(first), F.col("id").cast("int")).cast("timestamp_ntz").alias("date_month")
    )


def lookback(spine: DataFrame, col: str, params: Params) -> DataFrame:
    """Keep rows whose calendar year is at least ``year(as_of) - lookback_years``."""
    return spine.where(F.year(col) >= F.lit(params.as_of.year - params.lookback_years))


def cross_grid(entities: DataFrame, first: dt.date, last: dt.date, col: str) -> DataFrame:
    """Every entity with every month start from ``first`` to ``last``, generated per entity row (no join)."""
    months = F.sequence(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)), F.expr("interval 1 month"))
    return entities.select("*", F.explode(F.transform(months, lambda m: m.cast("timestamp_ntz"))).alias(col))


def log_bounds(staged: DataFrame, params: Params) -> DataFrame:
    """One row: the first observed day of the log, and the last day of its spine (``horizon_days`` past the last load).

    An empty log has NULL bounds, which give no spine rows.
    """
    return staged.agg(
        F.min("date_day_observed").cast("date").alias("first_day"),
        F.date_add(F.max("_data_loaded_date"), params.horizon_days).alias("last_day"),
    )


def _steps(bounds: DataFrame) -> DataFrame:
    days = F.datediff("last_day", "first_day")
    return bounds.where(days >= 0).select("first_day", F.explode(F.sequence(F.lit(0), days)).alias("numbers"))


def numbers_between(bounds: DataFrame) -> DataFrame:
    """0 .. days between the bounds, inclusive."""
    return _steps(bounds).select("numbers")


def dates_between(bounds: DataFrame) -> DataFrame:
    """One DATE per day from the first bound to the last."""
    return _steps(bounds).select(F.date_add("first_day", F.col("numbers")).alias("date_day"))


def months_of(days: DataFrame) -> DataFrame:
    """The distinct month starts of a day spine, as TIMESTAMP_NTZ."""
    return days.select(F.trunc("date_day", "month").cast("timestamp_ntz").alias("date_month")).distinct()
