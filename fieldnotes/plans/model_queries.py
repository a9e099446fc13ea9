"""Whole models: query name -> (Models attribute, oracle CTE)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import Query, models, register

MODEL_QUERIES = {
    "stg_observations": ("staged", "stg"),
    "numbers_spine": ("log_numbers", "log_numbers"),
    "dates_spine": ("log_dates", "log_dates"),
    "months_spine": ("log_months", "log_months"),
    "species_dim": ("species", "species"),
    "species_to_locations": ("species_to_locations", "species_to_locations"),
    "species_to_locations_by_key": ("species_to_locations_by_key", "species_to_locations_by_key"),
    "daily_summary": ("daily_summary", "daily_summary"),
    "monthly_summary": ("monthly_summary", "monthly_summary"),
    "daily_species_summary": ("daily_species_summary", "daily_species_summary"),
    "monthly_species_summary": ("monthly_species_summary", "monthly_species_summary"),
    "monthly_species_summary_by_location": (
        "monthly_species_summary_by_location", "monthly_species_summary_by_location"),
    "weekly_species_summary": ("weekly_species_summary", "weekly_species_summary"),
    "forecast_prep_species": ("forecast_prep_species", "forecast_prep_species"),
    "forecast_prep_species_location": ("forecast_prep_species_location", "forecast_prep_species_location"),
    "day_of_week_summary": ("day_of_week_summary", "day_of_week_summary"),
}


def _model_query(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = getattr(models(spark, sf_dir), attr)
        if attr == "staged":  # the decimals of the array as text, element by element
            model = model.withColumn("coordinates", F.col("coordinates").cast("array<string>"))
        return model
    run.__name__ = attr
    return run


for _name, (_attr, _cte) in MODEL_QUERIES.items():
    _sql = O.sql("SELECT * REPLACE (CAST(coordinates AS VARCHAR[]) AS coordinates) FROM stg", "stg") if _cte == "stg" else O.model(_cte)
    register(_name, _sql)(_model_query(_attr))
