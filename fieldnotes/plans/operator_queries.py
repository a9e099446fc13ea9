"""Single-operator queries: each isolates one operator of the
models, over the whole test tables, with its oracle SQL."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldnotes.functions import (
    array_get,
    coordinates,
    day_of_week_name,
    day_of_week_sunday0,
    month_key,
    parse_int_array,
    split_text,
    surrogate_key,
    ts_trunc_day,
    week_start_sunday,
)
from fieldnotes.operators import forecast, panel, rollups, spines
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import models, register
from fieldnotes.sources.testdata import events, raw_observations

AS_OF = O.d(P.as_of)
SHORT = dataclasses.replace(P, lookback_years=3)  # of the lookback that cuts something off the test log

# --- projections and filters ------------------------------------------------


@register("species_guess_correct", O.sql(
    "SELECT id, species_guess, preferred_common_name, species_guess_correct FROM stg", "stg"))
def species_guess_correct(spark, sf_dir):
    return models(spark, sf_dir).staged.select(
        "id", "species_guess", "preferred_common_name", "species_guess_correct")


@register("lookback_filter", O.sql(
    f"SELECT * FROM log_months WHERE year(date_month) >= {SHORT.as_of.year - SHORT.lookback_years}", "log_months"))
def lookback_filter(spark, sf_dir):
    return spines.lookback(models(spark, sf_dir).log_months, "date_month", SHORT)


@register("forecast_trim_partial", O.sql(
    f"SELECT * FROM forecast_prep_species WHERE ds < {O.ts(P.as_of.replace(day=1))}", "forecast_prep_species"))
def forecast_trim_partial(spark, sf_dir):
    return forecast.trim_partial(models(spark, sf_dir).forecast_prep_species, P)


# --- joins --------------------------------------------------------------------


@register("join_spine_left", O.sql("""
SELECT dates.date_day, a.date_day_observed, a.num_observations
FROM dates LEFT JOIN (SELECT date_day_observed, COUNT(*) AS num_observations FROM stg GROUP BY 1) a
  ON a.date_day_observed = dates.date_day""", "dates", "stg"))
def join_spine_left(spark, sf_dir):
    m = models(spark, sf_dir)
    in_range = m.staged.where(F.col("date_day_observed") <= F.lit(P.spine_end).cast("timestamp_ntz"))
    agg = in_range.groupBy("date_day_observed").agg(F.count(F.lit(1)).alias("num_observations"))
    return rollups.spine_left_join(
        m.dates, agg, F.col("date_day").cast("timestamp_ntz") == F.col("date_day_observed"))


@register("join_grid_left_2key", O.sql(
    f"SELECT * FROM monthly_species_summary_counts WHERE date_month_observed < {AS_OF}",
    "monthly_species_summary_counts"))
def join_grid_left_2key(spark, sf_dir):
    m = models(spark, sf_dir)
    return panel.grid_counts(m.species_facts, m.species, panel.MONTHLY_SPECIES, P)


@register("join_grid_left_3key", O.sql(
    f"SELECT * FROM monthly_species_summary_by_location_counts WHERE date_month_observed < {AS_OF}",
    "monthly_species_summary_by_location_counts"))
def join_grid_left_3key(spark, sf_dir):
    m = models(spark, sf_dir)
    return panel.grid_counts(m.location_facts, m.location_entities, panel.MONTHLY_SPECIES_LOCATION, P)


@register("grid_cross_join", O.sql(f"""
SELECT s.taxon_id, s.latin_name, s.preferred_common_name, m.date_month
FROM species s CROSS JOIN (SELECT * FROM months WHERE year(date_month) >= {O.LOOKBACK_YEAR}) m""",
    "species", "months"))
def grid_cross_join(spark, sf_dir):
    m = models(spark, sf_dir)
    first = max(P.epoch, dt.date(P.as_of.year - P.lookback_years, 1, 1))
    return spines.cross_grid(m.species.select("taxon_id", "latin_name", "preferred_common_name"), first, P.spine_end, "date_month")


# --- aggregations -----------------------------------------------------------


@register("agg_count", O.sql(
    "SELECT taxon_id, COUNT(*) AS num_observations FROM stg GROUP BY 1", "stg"))
def agg_count(spark, sf_dir):
    return models(spark, sf_dir).staged.groupBy("taxon_id").agg(F.count(F.lit(1)).alias("num_observations"))


@register("agg_count_distinct", O.sql(
    "SELECT taxon_id, COUNT(DISTINCT inaturalist_id) AS num_distinct_observations FROM stg GROUP BY 1", "stg"))
def agg_count_distinct(spark, sf_dir):
    return models(spark, sf_dir).staged.groupBy("taxon_id").agg(
        F.count_distinct("inaturalist_id").alias("num_distinct_observations"))


@register("agg_conditional_distinct", O.sql("""
SELECT date_month_observed, num_endemic_taxon_observed, num_native_taxon_observed, num_threatened_taxon_observed
FROM monthly_agg""", "monthly_agg"))
def agg_conditional_distinct(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    agg = rollups.period_aggregates(staged, month_key("date_day_observed"), "date_month_observed")
    return agg.select("date_month_observed", "num_endemic_taxon_observed", "num_native_taxon_observed",
                      "num_threatened_taxon_observed")


@register("agg_sum_bool", O.sql("""
SELECT taxon_id,
  CAST(COALESCE(SUM(CAST(endemic AS INTEGER)), 0) AS BIGINT) AS num_endemic_observations,
  CAST(COALESCE(SUM(CAST(native AS INTEGER)), 0) AS BIGINT) AS num_native_observations,
  CAST(COALESCE(SUM(CAST(threatened AS INTEGER)), 0) AS BIGINT) AS num_threatened_observations
FROM stg GROUP BY 1""", "stg"))
def agg_sum_bool(spark, sf_dir):
    zero = F.lit(0).cast("long")
    return models(spark, sf_dir).staged.groupBy("taxon_id").agg(
        *[F.coalesce(F.sum(F.col(f).cast("int")), zero).alias(f"num_{f}_observations")
          for f in ("endemic", "native", "threatened")])


@register("agg_sum", O.sql("""
SELECT taxon_id,
  CAST(SUM(num_observations) AS BIGINT) AS total_observations,
  CAST(COALESCE(SUM(num_correct_guesses), 0) AS INTEGER) AS total_correct_guesses
FROM monthly_species_summary GROUP BY 1""", "monthly_species_summary"))
def agg_sum(spark, sf_dir):
    return models(spark, sf_dir).monthly_species_panel.groupBy("taxon_id").agg(
        F.sum("num_observations").alias("total_observations"),
        F.coalesce(F.sum("num_correct_guesses"), F.lit(0)).cast("int").alias("total_correct_guesses"))


@register("agg_by_expr", O.sql("""
SELECT CAST(date_trunc('week', date_day_observed + INTERVAL 1 DAY) - INTERVAL 1 DAY AS TIMESTAMP) AS week_start,
  COUNT(*) AS num_observations
FROM stg GROUP BY 1""", "stg"))
def agg_by_expr(spark, sf_dir):
    return models(spark, sf_dir).staged.groupBy(
        week_start_sunday("date_day_observed").alias("week_start")).agg(
        F.count(F.lit(1)).alias("num_observations"))


# --- windows --------------------------------------------------------------------

def _panel_slice(name: str, daily: bool, cols: list[str]) -> None:
    model = "daily_species_summary" if daily else "monthly_species_summary"
    date_col = "date_day_observed" if daily else "date_month_observed"
    select = ", ".join([date_col, "taxon_id", *cols])

    def run(spark, sf_dir):
        m = models(spark, sf_dir)
        df = m.daily_species_panel if daily else m.monthly_species_panel
        return df.select(date_col, "taxon_id", *cols)

    run.__name__ = name
    register(name, O.sql(f"SELECT {select} FROM {model}", model))(run)


_panel_slice("win_lag_null", True, ["num_observations", "prior_day_observations"])
_panel_slice("win_lag_default", False,
             ["num_observations", "prior_month_observations", "one_year_ago_observations"])
_panel_slice("win_rolling_avg", False, ["num_observations", "avg_rolling_three_month_observations"])
_panel_slice("win_rolling_max", False, ["num_observations", "max_local_three_month_observations"])
_panel_slice("win_rolling_min", False, ["num_observations", "min_local_three_month_observations"])
_panel_slice("win_rolling_avg_change", False,
             ["mom_observations_change", "avg_rolling_three_month_mom_observations_change"])
_panel_slice("win_cumulative_sum", False,
             ["mom_observations_change", "cumulative_sum_mom_observations_change"])
_panel_slice("fn_integer_delta", False, [
    "prior_month_observations", "mom_observations_change", "mom_observations_delta",
    "one_year_ago_observations", "yoy_observations_change", "yoy_observations_delta"])


@register("win_partition_total", O.sql("""
SELECT date_month_observed, taxon_id, num_observations,
  CAST(SUM(num_observations) OVER (PARTITION BY taxon_id) AS BIGINT) AS total_observations
FROM monthly_species_summary""", "monthly_species_summary"))
def win_partition_total(spark, sf_dir):
    df = models(spark, sf_dir).monthly_species_panel
    return df.select("date_month_observed", "taxon_id", "num_observations",
                     F.sum("num_observations").over(Window.partitionBy("taxon_id")).alias("total_observations"))


# --- sorts ----------------------------------------------------------------------


@register("sort_nulls_last", O.sql(
    "SELECT date_day, date_day_observed, num_observations FROM daily_summary "
    "ORDER BY date_day_observed ASC NULLS LAST", "daily_summary"))
def sort_nulls_last(spark, sf_dir):
    return models(spark, sf_dir).daily_summary.select("date_day", "date_day_observed", "num_observations")


# --- scalar functions -------------------------------------------------------------


@register("fn_date_trunc_day", O.sql(
    "SELECT event_id, ts, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start FROM events"))
def fn_date_trunc_day(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", ts_trunc_day("ts").alias("day_start"))


@register("fn_date_trunc_month", O.sql(
    "SELECT event_id, ts, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start FROM events"))
def fn_date_trunc_month(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", month_key("ts").alias("month_start"))


@register("fn_parse_int_array", O.sql(
    f"SELECT id, place_ids, {O.PLACE_ARRAY} AS place_id_array FROM raw", "raw"))
def fn_parse_int_array(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    return raw.select("id", "place_ids", parse_int_array("place_ids").alias("place_id_array"))


@register("fn_split_array", O.sql(
    "SELECT id, location, string_split(location, ',') AS location_parts FROM raw", "raw"))
def fn_split_array(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    return raw.select("id", "location", split_text("location").alias("location_parts"))


@register("fn_coordinates", O.sql(
    "SELECT id, location, CAST(CAST(string_split(location, ',') AS DECIMAL(12,6)[]) AS VARCHAR[]) AS coordinates FROM raw", "raw"))
def fn_coordinates(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    return raw.select("id", "location", coordinates("location").cast("array<string>").alias("coordinates"))  # every element as text


@register("fn_array_get", O.sql(
    "SELECT id, coordinates[1] AS first_part, coordinates[2] AS second_part, coordinates[3] AS third_part "
    "FROM stg", "stg"))
def fn_array_get(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    return staged.select("id", *[array_get("coordinates", i).alias(n) for i, n in
                                 ((1, "first_part"), (2, "second_part"), (3, "third_part"))])


@register("fn_round_decimal", O.sql(
    "SELECT id, CAST(round(latitude, 2) AS DECIMAL(12,2)) AS latitude_2, "
    "CAST(round(longitude, 2) AS DECIMAL(12,2)) AS longitude_2 FROM stg", "stg"))
def fn_round_decimal(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    return staged.select("id", F.round("latitude", 2).cast("decimal(12,2)").alias("latitude_2"),
                         F.round("longitude", 2).cast("decimal(12,2)").alias("longitude_2"))


@register("fn_surrogate_key", O.sql(
    f"SELECT id, {O.skey('taxon_id', 'species_guess')} AS guess_key, "
    f"{O.skey('taxon_id', 'location_id')} AS species_location_id FROM stg", "stg"))
def fn_surrogate_key(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    return staged.select("id", surrogate_key("taxon_id", "species_guess").alias("guess_key"),
                         surrogate_key("taxon_id", "location_id").alias("species_location_id"))


@register("fn_null_safe_ratio", O.sql(
    "SELECT date_day, pct_observations_guessed_correctly, pct_taxon_endemic, pct_taxon_native, "
    "pct_taxon_threatened FROM daily_summary", "daily_summary"))
def fn_null_safe_ratio(spark, sf_dir):
    return models(spark, sf_dir).daily_summary.select(
        "date_day", "pct_observations_guessed_correctly", "pct_taxon_endemic", "pct_taxon_native",
        "pct_taxon_threatened")


@register("fn_week_start_sunday", O.sql(
    "SELECT id, date_day_observed, CAST(date_trunc('week', date_day_observed + INTERVAL 1 DAY) "
    "- INTERVAL 1 DAY AS TIMESTAMP) AS week_start FROM stg", "stg"))
def fn_week_start_sunday(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    return staged.select("id", "date_day_observed", week_start_sunday("date_day_observed").alias("week_start"))


@register("fn_day_of_week", O.sql(
    "SELECT id, date_day_observed, CAST(dayofweek(date_day_observed) AS INTEGER) AS day_of_week, "
    "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"
    "[dayofweek(date_day_observed) + 1] AS day_name FROM stg", "stg"))
def fn_day_of_week(spark, sf_dir):
    staged = models(spark, sf_dir).staged
    dow = day_of_week_sunday0("date_day_observed")
    return staged.select("id", "date_day_observed", dow.alias("day_of_week"), day_of_week_name(dow).alias("day_name"))


@register("fn_forecast_type", O.sql("""
SELECT DISTINCT CAST(unique_id AS VARCHAR) AS unique_id, 'monthly_species_summary' AS forecast_type
FROM forecast_prep_species
UNION ALL
SELECT DISTINCT unique_id, 'monthly_species_summary_by_location' AS forecast_type
FROM forecast_prep_species_location""", "forecast_prep_species", "forecast_prep_species_location"))
def fn_forecast_type(spark, sf_dir):
    m = models(spark, sf_dir)

    def typed(df, view):
        return df.select(F.col("unique_id").cast("string").alias("unique_id")).distinct().select(
            "unique_id", forecast.forecast_type_of(F.lit(f"public.forecast_prep__{view}")).alias("forecast_type"))

    return typed(m.forecast_prep_species, "monthly_species_summary").unionByName(
        typed(m.forecast_prep_species_location, "monthly_species_summary_by_location"))
