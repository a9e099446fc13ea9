"""Typed staging of the raw observation log, and the forecasts passthrough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.functions import array_get, coordinates, parse_int_array, surrogate_key, ts_trunc_day
from fieldnotes.params import Params

DATE_PARTS = ("observed_month", "observed_hour", "observed_week", "observed_year", "observed_day")


def _to_int(col: str) -> F.Column:
    # float -> integer casts round half to even in the database; Spark truncates.
    return F.bround(F.col(col), 0).cast("int")


def stage_observations(raw: DataFrame, params: Params) -> DataFrame:
    """One typed row per raw version, with coordinates and a location key.

    The lower time bound is a plain predicate on the raw column, so it reaches
    the scan; a NULL ``observed_date`` fails it as well.
    """
    base = raw.where(F.col("observed_date") >= F.lit(params.epoch).cast("timestamp_ntz")).select(
        "id",
        "inaturalist_id",
        "taxon_id",
        F.col("name").alias("latin_name"),
        "preferred_common_name",
        ts_trunc_day("observed_date").alias("date_day_observed"),
        *[_to_int(c).alias(c) for c in DATE_PARTS],
        "updated_at",
        "species_guess",
        (F.col("species_guess") == F.col("preferred_common_name")).alias("species_guess_correct"),
        parse_int_array("place_ids").alias("place_id_array"),
        coordinates("location").alias("coordinates"),
        "endemic",
        "native",
        "introduced",
        "threatened",
        "rank",
        "wikipedia_url",
        "_data_loaded_date",
    )
    lat = array_get("coordinates", 1)
    lon = array_get("coordinates", 2)
    return base.select(
        "*",
        lat.alias("latitude"),
        lon.alias("longitude"),
        # rounding to 2 decimals puts observations within about 1.1 km in one cell
        surrogate_key(F.round(lat, 2).cast("decimal(12,2)"),
                      F.round(lon, 2).cast("decimal(12,2)")).alias("location_id"),
    )


def species_level(staged: DataFrame, params: Params) -> DataFrame:
    """Facts whose taxon is ranked species or subspecies."""
    return staged.where(F.col("rank").isin(*params.species_ranks))


def stage_forecasts(forecasts: DataFrame) -> DataFrame:
    """Passthrough view of the stored forecasts."""
    return forecasts.select("*")
