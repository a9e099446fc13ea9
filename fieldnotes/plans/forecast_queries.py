"""Forecast queries: the SQL baseline with an oracle, the grouped
fits (rows-only), the stamped output and the stored-forecasts passthrough."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldnotes.operators import forecast, incremental, model_map, order_search, staging
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import models, register
from fieldnotes.schemas import FORECAST
from fieldnotes.session import scratch_path

SPECIES_VIEW = "monthly_species_summary"
LOCATION_VIEW = "monthly_species_summary_by_location"


@register("forecast_seasonal_naive", O.sql("SELECT * FROM naive_species", "naive_species"))
def forecast_seasonal_naive(spark, sf_dir):
    series = forecast.trim_partial(models(spark, sf_dir).forecast_prep_species, P)
    return forecast.seasonal_naive(series, P)


@register("forecast_future_dates", O.sql(
    "SELECT unique_id, h, ds FROM naive_species_steps", "naive_species_steps"))
def forecast_future_dates(spark, sf_dir):
    series = forecast.trim_partial(models(spark, sf_dir).forecast_prep_species, P)
    last = series.groupBy(F.col("unique_id").cast("string").alias("unique_id")).agg(F.max("ds").alias("last_ds"))
    steps = last.select("unique_id", "last_ds", F.explode(F.sequence(F.lit(1), F.lit(P.h))).alias("h"))
    return steps.select("unique_id", "h", forecast.future_dates(F.col("last_ds"), F.col("h")).alias("ds"))


@register("forecast_grouped", O.sql("SELECT * FROM lsq_species", "lsq_species"))
def forecast_grouped(spark, sf_dir):
    series = forecast.trim_partial(models(spark, sf_dir).forecast_prep_species, P)
    return forecast.grouped_forecast(series, P)


def _stamped_sql(prefix: str, forecast_type: str) -> str:
    return (f"SELECT ds, unique_id, y_hat AS auto_arima, y_hat_lo AS auto_arima_lo_90, "
            f"y_hat_hi AS auto_arima_hi_90, '{forecast_type}' AS forecast_type, {O.d(P.as_of)} AS _date_forecasted "
            f"FROM {prefix}")


def _both_sql(kind: str, suffix: str = "") -> str:
    return O.sql(_stamped_sql(f"{kind}_species", SPECIES_VIEW + suffix) + "\nUNION ALL\n"
                 + _stamped_sql(f"{kind}_location", LOCATION_VIEW + suffix), f"{kind}_species", f"{kind}_location")


@register("forecast_stamped", O.sql(_stamped_sql("lsq_location", LOCATION_VIEW), "lsq_location"))
def forecast_stamped(spark, sf_dir):
    series = forecast.trim_partial(models(spark, sf_dir).forecast_prep_species_location, P)
    core = forecast.grouped_forecast(series, P)
    return forecast.stamp(core, LOCATION_VIEW, P.as_of, P.level)


@register("forecast_all", _both_sql("lsq"))
def forecast_all(spark, sf_dir):
    m = models(spark, sf_dir)
    return forecast.forecast_all(m.forecast_prep_species, m.forecast_prep_species_location, P)


ORDER = "unique_id, d, p, s, n, aicc"


@register("forecast_orders", O.sql(
    f"SELECT '{SPECIES_VIEW}' AS forecast_type, {ORDER} FROM search_species_chosen\nUNION ALL\n"
    f"SELECT '{LOCATION_VIEW}' AS forecast_type, {ORDER} FROM search_location_chosen", "search_species_chosen", "search_location_chosen"))
def forecast_orders(spark, sf_dir):
    """The chosen order of every series of both grains, with its AICc."""
    m = models(spark, sf_dir)
    series = forecast.both_grains(m.forecast_prep_species, m.forecast_prep_species_location, P)
    return order_search.chosen_orders(series, P, ("forecast_type", "unique_id")).select("forecast_type", "unique_id", "d", "p", "s", "n", "aicc")


@register("forecast_order_search", _both_sql("search"))
def forecast_order_search(spark, sf_dir):
    m = models(spark, sf_dir)
    return forecast.forecast_all(m.forecast_prep_species, m.forecast_prep_species_location, P, model="order_search")


@register("forecast_model_map", O.sql(
    f"SELECT '{SPECIES_VIEW}' AS forecast_type, *, CAST(NULL AS VARCHAR) AS failure FROM naive_species\nUNION ALL\n"
    f"SELECT '{LOCATION_VIEW}' AS forecast_type, *, CAST(NULL AS VARCHAR) AS failure FROM naive_location", "naive_species", "naive_location"))
def forecast_model_map(spark, sf_dir):
    """A caller's numpy model, run once per series of both grains."""
    m = models(spark, sf_dir)
    series = forecast.both_grains(m.forecast_prep_species, m.forecast_prep_species_location, P)
    return model_map.map_models(series, model_map.seasonal_repeat(P.season), P, ("forecast_type", "unique_id"))


@register("stg_forecasts", _both_sql("naive", forecast.NAIVE_SUFFIX))
def stg_forecasts(spark, sf_dir):
    """Baseline forecasts of both grains appended to a forecasts table, then
    read back through the staging passthrough."""
    m = models(spark, sf_dir)
    out = forecast.forecast_all(m.forecast_prep_species, m.forecast_prep_species_location, P,
                                model="seasonal_naive")
    path = scratch_path(spark, "forecasts")
    incremental.append(out, path, partition_by=["_date_forecasted"])
    stored = spark.read.schema(FORECAST).parquet(path)
    return staging.stage_forecasts(stored)
