"""Whole-population rollups, the day-of-week analysis and the weekly rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.functions import (
    day_of_week_name,
    day_of_week_sunday0,
    month_key,
    null_safe_ratio,
    week_start_sunday,
    zero_guarded_ratio,
)
from fieldnotes.params import Params

FLAGS = ("endemic", "native", "threatened")


def _as_int(flag: str) -> F.Column:
    return F.col(flag).cast("int")


def period_aggregates(staged: DataFrame, key: F.Column, key_name: str) -> DataFrame:
    """The nine per-period aggregates, without a multi-distinct Expand.

    ``COUNT(DISTINCT taxon)`` and the three conditional distinct counts are
    computed in two partial-aggregated steps: first per (period, taxon) with
    row counts, flag sums and "any flag set", then per period by counting
    taxa. Both steps combine map-side, so a hot period or taxon is folded
    before the shuffle and no row is replicated.
    """
    per_taxon = staged.groupBy(key.alias(key_name), "taxon_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_as_int("species_guess_correct")).alias("correct"),
        *[F.sum(_as_int(f)).alias(f"sum_{f}") for f in FLAGS],
        *[F.max(f).alias(f"any_{f}") for f in FLAGS],
    )
    zero = F.lit(0).cast("long")
    return per_taxon.groupBy(key_name).agg(
        F.coalesce(F.sum("n"), zero).alias("num_observations"),
        F.count("taxon_id").alias("num_taxon_observed"),
        F.coalesce(F.sum("correct"), zero).alias("num_correct_guesses"),
        F.count(F.when(F.col("any_endemic"), F.col("taxon_id"))).alias("num_endemic_taxon_observed"),
        F.coalesce(F.sum("sum_endemic"), zero).alias("num_endemic_observations"),
        F.count(F.when(F.col("any_native"), F.col("taxon_id"))).alias("num_native_taxon_observed"),
        F.coalesce(F.sum("sum_native"), zero).alias("num_native_observations"),
        F.count(F.when(F.col("any_threatened"), F.col("taxon_id"))).alias("num_threatened_taxon_observed"),
        F.coalesce(F.sum("sum_threatened"), zero).alias("num_threatened_observations"),
    )


def with_ratios(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        null_safe_ratio("num_correct_guesses", "num_observations").alias("pct_observations_guessed_correctly"),
        null_safe_ratio("num_endemic_taxon_observed", "num_taxon_observed").alias("pct_taxon_endemic"),
        null_safe_ratio("num_native_taxon_observed", "num_taxon_observed").alias("pct_taxon_native"),
        null_safe_ratio("num_threatened_taxon_observed", "num_taxon_observed").alias("pct_taxon_threatened"),
    )


def spine_left_join(spine: DataFrame, agg: DataFrame, cond: F.Column) -> DataFrame:
    # The aggregate holds one row per spine period at most; the planner sees its size at run time.
    return spine.join(agg, cond, "left")


def daily_summary(staged: DataFrame, days: DataFrame, params: Params) -> DataFrame:
    """Day spine LEFT JOIN per-day aggregates; gap days are all NULL."""
    in_range = staged.where(
        F.col("date_day_observed") <= F.lit(params.spine_end).cast("timestamp_ntz")
    )
    agg = period_aggregates(in_range, F.col("date_day_observed"), "date_day_observed")
    joined = spine_left_join(
        days, agg, F.col("date_day").cast("timestamp_ntz") == F.col("date_day_observed")
    )
    out = with_ratios(joined)
    if params.order_output:
        out = out.orderBy(F.col("date_day_observed").asc_nulls_last())
    return out


def monthly_summary(staged: DataFrame, months: DataFrame, params: Params) -> DataFrame:
    """Month spine LEFT JOIN per-month aggregates."""
    last_month = params.spine_end.replace(day=1)
    in_range = staged.where(
        F.col("date_day_observed") < F.lit(_next_month(last_month)).cast("timestamp_ntz")
    )
    agg = period_aggregates(in_range, month_key("date_day_observed"), "date_month_observed")
    joined = spine_left_join(months, agg, F.col("date_month") == F.col("date_month_observed"))
    out = with_ratios(joined)
    if params.order_output:
        out = out.orderBy(F.col("date_month_observed").asc_nulls_last())
    return out


def _next_month(d):
    return d.replace(year=d.year + d.month // 12, month=d.month % 12 + 1, day=1)


def day_of_week_summary(staged: DataFrame, params: Params) -> DataFrame:
    """Observations per weekday since ``dow_since``, labelled, Sunday first."""
    counts = (
        staged.where(F.col("date_day_observed") >= F.lit(params.dow_since).cast("timestamp_ntz"))
        .groupBy(day_of_week_sunday0("date_day_observed").alias("int_day_of_week"))
        .agg(F.count(F.lit(1)).alias("num_observations"))
    )
    return counts.orderBy("int_day_of_week").select(
        day_of_week_name("int_day_of_week").alias("_day_of_week"), "num_observations"
    )


def weekly_species_summary(daily_panel: DataFrame) -> DataFrame:
    """Sunday-start weekly sums per taxon with a 52-row lag and a YoY ratio.

    ``daily_panel`` is the (unsorted) daily species panel, hash-partitioned
    by taxon, so the weekly grouping and the lag window reuse that layout.
    """
    weekly = daily_panel.groupBy(
        F.col("taxon_id").alias("unique_id"),
        week_start_sunday("date_day_observed").alias("ds"),
    ).agg(F.sum("num_observations").alias("y"))
    w = Window.partitionBy("unique_id").orderBy("ds")
    lagged = weekly.withColumn("one_year_ago_y", F.lag("y", 52).over(w))
    return lagged.withColumn(
        "yoy_delta", zero_guarded_ratio(F.col("y") - F.col("one_year_ago_y"), "one_year_ago_y")
    )
