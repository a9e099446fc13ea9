"""Forecast inputs, a seasonal-naive baseline, and least-squares fits per series, all in built-ins.

Series are long ``(unique_id, ds, y)`` frames. Every per-series step is keyed
by ``unique_id``; a series is at most a few dozen monthly points (the prep
lookback bounds it), so a group never outgrows one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.params import Params
from fieldnotes.schemas import FORECAST, conform

# Fixed value: the standard normal quantile for a two-sided 90 % interval.
Z90 = 1.6448536269514722

# Fixed value: the pattern that cuts the run name out of the source query text.
FORECAST_TYPE_SPLIT = r"[.\n](forecast_prep__)"

# what the forecast type of the baseline ends with
NAIVE_SUFFIX = "__seasonal_naive"


def prep(panel: DataFrame, key: str, min_total: int, params: Params) -> DataFrame:
    """Last ``prep_lookback_years`` calendar years (and the current one) of a
    monthly panel, keeping series whose total is strictly above ``min_total``.

    Only ``num_observations`` is read, so Catalyst prunes the panel's window
    columns and the year filter reaches the aggregation below.
    """
    recent = panel.where(
        F.year("date_month_observed") >= F.lit(params.as_of.year - params.prep_lookback_years)
    )
    total = F.sum("num_observations").over(Window.partitionBy(key))
    return (
        recent.select(
            F.col("date_month_observed").alias("ds"),
            F.col(key).alias("unique_id"),
            F.col("num_observations").alias("y"),
            total.alias("_total"),
        )
        .where(F.col("_total") > F.lit(min_total))
        .select("ds", "unique_id", "y")
    )


def trim_partial(series: DataFrame, params: Params) -> DataFrame:
    """Drop the unfinished month (the one containing ``as_of``) of every series."""
    return series.where(F.col("ds") < F.lit(params.as_of.replace(day=1)).cast("timestamp_ntz"))


def future_dates(last_ds: F.Column, step: F.Column) -> F.Column:
    """Month-end date ``step`` months after ``last_ds`` (pandas ``freq='M'``)."""
    return F.last_day(F.add_months(last_ds.cast("date"), step)).cast("timestamp_ntz")


def seasonal_naive(series: DataFrame, params: Params, keys: tuple[str, ...] = ("unique_id",)) -> DataFrame:
    """Seasonal-naive forecast with normal bounds, in DataFrame operators only.

    Point: the value one season before the target month. Spread: root mean
    square of the seasonal differences of the series. Output columns follow
    ``FORECAST_CORE`` plus any extra key columns.
    """
    season, h = params.season, params.h
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("ds")
    diffs = series.withColumn("_e", F.col("y") - F.lag("y", season).over(w))
    stats = diffs.groupBy(*keys).agg(
        F.max("ds").alias("_last"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("_s"),
    )
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("_h"))
    # step k repeats the same month of the last season of the series
    back = (F.col("_h") - 1) % season + 1 - season
    src = steps.withColumn("_src", F.add_months(F.col("_last").cast("date"), back).cast("timestamp_ntz"))
    past = series.select(*keys, F.col("ds").alias("_src"), F.col("y").alias("_y"))
    joined = src.join(past, [*keys, "_src"], "left")
    z = F.lit(params_z(params.level))
    y_hat = F.col("_y").cast("double")
    extra = [k for k in keys if k != "unique_id"]
    return joined.select(
        F.col("unique_id").cast("string").alias("unique_id"),
        future_dates(F.col("_last"), F.col("_h")).alias("ds"),
        y_hat.alias("y_hat"),
        (y_hat - z * F.col("_s")).alias("y_hat_lo"),
        (y_hat + z * F.col("_s")).alias("y_hat_hi"),
        *extra,
    )


def params_z(level: int) -> float:
    if level == 90:
        return Z90
    from statistics import NormalDist

    return NormalDist().inv_cdf(0.5 + level / 200.0)


def recursion(first: str, step: str, k: int) -> str:
    """``step`` applied ``k`` times to ``first``; ``{x}`` stands for the value so far. Plain arithmetic, the same in every SQL."""
    out = first
    for _ in range(k):
        out = f"({step.format(x=out)})"
    return out


def step_sql(k: int, season: int) -> tuple[str, str]:
    """What month ``k`` adds to the month of the last season, and its variance, from a, b, e and s2 (see ``grouped_forecast``)."""
    steps = range(k, 0, -season)  # the same month of each season up to here
    change = " + ".join(recursion("e", "a + b * {x}", j) for j in steps)
    spread = " + ".join(recursion("CAST(1 AS DOUBLE)", "1 + b * b * {x}", j - 1) for j in steps)
    return f"({change})", f"(s2 * ({spread}))"


def grouped_forecast(series: DataFrame, params: Params, keys: tuple[str, ...] = ("unique_id",)) -> DataFrame:
    """One least-squares model per series: the change against the same month of the last season follows its own value one
    month before, ``e' = a + b * e``.

    ``a``, ``b`` and the variance ``s2`` of the residuals come from whole-number sums over the series, which are exact in
    any order, so the fit is a partial aggregation. Where the sums determine no line (too few months, or all changes
    alike but one) the forecast is NULL. Bounds are normal, at ``params.level``.
    """
    season, keys = params.season, list(keys)
    w = Window.partitionBy(*keys).orderBy("ds")
    diffs = series.select(*[F.col(k).cast("string").alias(k) for k in keys], "ds", F.col("y").cast("long").alias("y"))
    diffs = diffs.withColumn("z", F.col("y") - F.lag("y", season).over(w)).withColumn("x", F.lag("z", 1).over(w))
    both = F.col("x").isNotNull() & F.col("z").isNotNull()
    total = {n: F.sum(F.when(both, F.expr(e))).alias(n) for n, e in
             (("n", "1L"), ("sx", "x"), ("sz", "z"), ("sxx", "x * x"), ("sxz", "x * z"), ("szz", "z * z"))}
    fit = diffs.groupBy(*keys).agg(*total.values(), F.max("ds").alias("last_ds"), F.max_by("z", "ds").alias("last_z"))
    fit = fit.withColumn("b", F.expr("CAST(n * sxz - sx * sz AS DOUBLE) / CAST(nullif(n * sxx - sx * sx, 0) AS DOUBLE)"))
    fit = fit.withColumn("a", F.expr("(CAST(sz AS DOUBLE) - b * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE)"))
    fit = fit.withColumn("s2", F.expr(
        "CASE WHEN b IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), CAST(szz AS DOUBLE) - a * CAST(sz AS DOUBLE) - b * CAST(sxz AS DOUBLE)) / CAST(n AS DOUBLE) END"))
    fit = fit.withColumn("e", F.col("last_z").cast("double"))
    steps = []
    for k in range(1, params.h + 1):
        change, spread = step_sql(k, season)
        steps.append(F.struct(F.lit(k).alias("k"), F.lit((k - 1) % season + 1 - season).alias("back"),
                              F.expr(change).alias("change"), F.sqrt(F.expr(spread)).alias("spread")))
    steps = fit.select(*keys, "last_ds", F.explode(F.array(*steps)).alias("s"))
    source = F.add_months(F.col("last_ds").cast("date"), F.col("s.back")).cast("timestamp_ntz")
    past = diffs.select(*keys, F.col("ds").alias("_src"), F.col("y").alias("_y"))
    joined = steps.withColumn("_src", source).join(past, [*keys, "_src"], "left")
    z, y_hat = F.lit(params_z(params.level)), F.col("_y").cast("double") + F.col("s.change")
    return joined.select("unique_id", future_dates(F.col("last_ds"), F.col("s.k")).alias("ds"), y_hat.alias("y_hat"),
                         (y_hat - z * F.col("s.spread")).alias("y_hat_lo"), (y_hat + z * F.col("s.spread")).alias("y_hat_hi"),
                         *[k for k in keys if k != "unique_id"])


def forecast_type_of(query_text: F.Column) -> F.Column:
    """The last piece of the source query text split on ``FORECAST_TYPE_SPLIT``."""
    return F.element_at(F.split(query_text, FORECAST_TYPE_SPLIT), -1)


def stamp(core: DataFrame, forecast_type: F.Column | str, as_of: dt.date, level: int = 90) -> DataFrame:
    """Rename model outputs to the stored names and stamp the run. The names say 90, so no other level goes in."""
    if level != 90:
        raise ValueError(f"the stored bounds are those of 90 %, not {level} %")
    ft = F.lit(forecast_type) if isinstance(forecast_type, str) else forecast_type
    return conform(
        core.select(
            "ds", "unique_id",
            F.col("y_hat").alias("auto_arima"),
            F.col("y_hat_lo").alias("auto_arima_lo_90"),
            F.col("y_hat_hi").alias("auto_arima_hi_90"),
            ft.alias("forecast_type"),
            F.lit(as_of).alias("_date_forecasted"),
        ),
        FORECAST,
    )


Fit = Callable[..., DataFrame]  # (series, params, keys) -> FORECAST_CORE and further keys


def both_grains(prep_species: DataFrame, prep_location: DataFrame, params: Params, suffix: str = "") -> DataFrame:
    """The finished months of both grains' series as one frame, told apart by ``forecast_type``."""

    def tag(df: DataFrame, view: str) -> DataFrame:
        return trim_partial(df, params).select(
            F.col("unique_id").cast("string").alias("unique_id"), "ds", "y", F.lit(f"{view}{suffix}").alias("forecast_type"))

    return tag(prep_species, "monthly_species_summary").unionByName(tag(prep_location, "monthly_species_summary_by_location"))


def forecast_all(prep_species: DataFrame, prep_location: DataFrame, params: Params,
                 model: str | Fit = "grouped") -> DataFrame:
    """Both grains in one job: union the series and fit per (type, id), by a named model or a caller's own."""
    from fieldnotes.operators.order_search import order_search

    naive = model == "seasonal_naive"
    named = {"grouped": grouped_forecast, "seasonal_naive": seasonal_naive, "order_search": order_search}
    fit = named[model] if isinstance(model, str) else model
    series = both_grains(prep_species, prep_location, params, NAIVE_SUFFIX if naive else "")
    core = fit(series, params, keys=("forecast_type", "unique_id"))
    return stamp(core, F.col("forecast_type"), params.as_of, params.level)
