"""The three jobs of the pipeline, as a Spark user would schedule them.

* ``ingest``    - landed API pages -> new rows of the observation log.
* ``transform`` - the log -> every model, written as Parquet tables. Staging
                  is written once and read back, so downstream models scan
                  the compact staged table instead of re-deriving it; the
                  incremental dimensions are merged by key. Each table is written once, as a
                  new version beside the one that readers see until it is committed.
* ``forecast``  - forecast-prep tables -> appended, stamped forecasts.

Tables live under the shared folder (``spark.checkpoint.dir``) unless a
location is given, so every executor can read what another wrote.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.operators import forecast as fc
from fieldnotes.operators import incremental, rejects
from fieldnotes.operators.versions import PartTable
from fieldnotes.params import Params
from fieldnotes.plans.models import Models
from fieldnotes.schemas import FORECAST, RAW_OBSERVATION
from fieldnotes.session import shared_dir
from fieldnotes.sources import api_pages

# model name -> (Models attribute, upsert key or None for a full rewrite)
TRANSFORM_MODELS = {
    "numbers": ("numbers", None),
    "dates": ("dates", None),
    "months": ("months", None),
    "species": ("species", ["taxon_id"]),
    "species_to_locations": ("species_to_locations", ["id", "latin_name", "preferred_common_name",
                                                      "most_recent_observation_date", "first_observation_date"]),
    "daily_summary": ("daily_summary", None),
    "monthly_summary": ("monthly_summary", None),
    "daily_species_summary": ("daily_species_summary", None),
    "monthly_species_summary": ("monthly_species_summary", ["id"]),
    "monthly_species_summary_by_location": ("monthly_species_summary_by_location", ["id"]),
    "weekly_species_summary": ("weekly_species_summary", None),
    "forecast_prep__monthly_species_summary": ("forecast_prep_species", None),
    "forecast_prep__monthly_species_summary_by_location": ("forecast_prep_species_location", None),
    "day_of_week_summary": ("day_of_week_summary", None),
}


# stored model -> the Models attribute that later models take it as
STORED_PANELS = {
    "species": "species",
    "daily_species_summary": "daily_species_panel",
    "monthly_species_summary": "monthly_species_panel",
    "monthly_species_summary_by_location": "monthly_species_location_panel",
}


# the forecast inputs: the series id is a taxon, or the key of a taxon at a place
SERIES = {name: T.StructType([T.StructField("ds", T.TimestampNTZType()), T.StructField("unique_id", kind), T.StructField("y", T.IntegerType())])
          for name, kind in (("monthly_species_summary", T.IntegerType()), ("monthly_species_summary_by_location", T.StringType()))}


def _root(spark: SparkSession, location: str | None) -> str:
    return (location or f"{shared_dir(spark)}/warehouse").rstrip("/")


def ingest(spark: SparkSession, landing: str, params: Params, location: str | None = None, lenient: bool = False) -> int:
    """Append the new observation versions found in the landed pages.

    A landed line that is no page, or a row that cannot be staged, ends the job; a ``lenient`` one goes on without
    them and appends them with the reason to ``rejected_pages`` and ``rejected_observations``.

    The high-water mark of the stored log (one aggregated value) selects the
    pull: landing folders from that day on (partition pruning when pages are
    landed by ``load_date``) and rows updated on or after it. The rows are
    then deduplicated against stored ids. Without a stored log, everything
    is loaded.
    """
    log_path = f"{_root(spark, location)}/observations"
    since = None
    if incremental.table_exists(spark, log_path):
        log = stored_log(spark, location)
        last = log.agg(F.max(incremental.MONTH)).first()[0]  # then that month's folder only
        mark = incremental.high_water_mark(log.where(F.col(incremental.MONTH) == F.lit(last))).first()["high_water_mark"]
        since = dt.date.fromisoformat(mark) if mark else None
    if lenient:
        pages, bad_pages = rejects.split_pages(api_pages.read_page_texts(spark, landing, since))
    else:
        pages = api_pages.read_pages(spark, landing, since)
    results = api_pages.wild(api_pages.explode_results(pages), params.captive)
    batch = api_pages.flatten_results(results, params.as_of)
    if lenient:
        batch, bad_rows = rejects.split_raw(batch)
        for name, bad in (("rejected_pages", bad_pages), ("rejected_observations", bad_rows)):
            incremental.append(bad.withColumn("_date_rejected", F.lit(params.as_of)), f"{_root(spark, location)}/{name}")
    batch = api_pages.source_filter(batch, updated_since=since, taxon_ids=params.taxon_ids, place_ids=params.places)
    return incremental.load_increment(spark, batch, log_path, RAW_OBSERVATION)


def stored_log(spark: SparkSession, location: str | None = None) -> DataFrame:
    """The log with its partition column, the month of the row version."""
    return spark.read.schema(incremental.with_month_schema(RAW_OBSERVATION)).parquet(f"{_root(spark, location)}/observations")


def stored_model(spark: SparkSession, name: str, location: str | None = None) -> PartTable:
    """The table of a model that ``transform`` writes."""
    return PartTable(spark, f"{_root(spark, location)}/{name}")


def _store(spark: SparkSession, path: str, df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``df`` as the new version of the table at ``path``, merged by ``keys`` into the one before if there are any; the stored rows.

    The table is written once, beside the version that readers see until the new one is committed.
    """
    table = PartTable(spark, path)
    if keys:
        df = incremental.upsert(table.read(df.schema), df, keys)
    return table.replace(df)


def transform(spark: SparkSession, params: Params, location: str | None = None,
              only: list[str] | None = None) -> dict[str, DataFrame]:
    """Build the models from the stored log; returns model name -> stored rows.

    Rows of a stored table have no order for its readers, so the models are
    built without their final global sorts (a range shuffle each).
    """
    params = dataclasses.replace(params, order_output=False)
    root = _root(spark, location)
    raw = stored_log(spark, location).select(*RAW_OBSERVATION.names)
    out = {"stg_observations": _store(spark, f"{root}/stg_observations", Models(spark, raw, params).staged)}
    models = Models(spark, None, params, staged=out["stg_observations"])
    for name, (attr, keys) in TRANSFORM_MODELS.items():
        if only and name not in only:
            continue
        out[name] = _store(spark, f"{root}/{name}", getattr(models, attr), keys)
        if name in STORED_PANELS:  # what is built on a panel reads the stored one
            models.__dict__[STORED_PANELS[name]] = out[name]
    return out


def forecast(spark: SparkSession, params: Params, location: str | None = None, model: str = "order_search") -> int:
    """Forecast both grains from the prep tables into ``forecasts``; a repeated run replaces its own day and types."""
    root = _root(spark, location)
    species, by_location = (stored_model(spark, f"forecast_prep__{t}", location).read(SERIES[t])
                            for t in ("monthly_species_summary", "monthly_species_summary_by_location"))
    out = fc.forecast_all(species, by_location, params, model=model)
    path = f"{root}/forecasts"
    staging = f"{path}_run_{params.as_of.isoformat()}"
    if incremental.table_exists(spark, path):  # rows of the same day and other types stay
        stored = spark.read.schema(FORECAST).parquet(path).where(F.col("_date_forecasted") == F.lit(params.as_of))
        out = out.unionByName(stored.join(out.select("forecast_type").distinct(), "forecast_type", "left_anti").select(*out.columns))
    out.write.mode("overwrite").parquet(staging)
    written = spark.read.schema(FORECAST).parquet(staging)
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_date_forecasted").parquet(path)
    types = ["monthly_species_summary", "monthly_species_summary_by_location"]
    suffix = fc.NAIVE_SUFFIX if model == "seasonal_naive" else ""
    return written.where(F.col("forecast_type").isin([t + suffix for t in types])).count()


def stored_forecasts(spark: SparkSession, location: str | None = None) -> DataFrame:
    return spark.read.schema(FORECAST).parquet(f"{_root(spark, location)}/forecasts").select(
        *[F.col(f.name) for f in FORECAST.fields])
