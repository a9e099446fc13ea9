"""The model graph: raw log -> staging -> dimensions -> rollups -> panels -> prep.

``Models`` builds each model lazily from one raw DataFrame, so a caller can
ask for any node and Spark plans only what that node needs. Models that feed
several others are built once per ``Models`` object.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fieldnotes.operators import dims, forecast, panel, rollups, spines, staging
from fieldnotes.params import Params


class Models:
    def __init__(self, spark: SparkSession, raw: DataFrame | None, params: Params,
                 staged: DataFrame | None = None):
        """``raw`` is the observation log; pass ``staged`` instead to build on
        an already materialized staging table."""
        if raw is None and staged is None:
            raise ValueError("need the raw log or a staged table")
        self.spark = spark
        self.raw = raw
        self.params = params
        if staged is not None:
            self.__dict__["staged"] = staged

    # staging and spines -------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        return staging.stage_observations(self.raw, self.params)

    @cached_property
    def species_facts(self) -> DataFrame:
        return staging.species_level(self.staged, self.params)

    @cached_property
    def numbers(self) -> DataFrame:
        return spines.numbers_spine(self.spark, self.params)

    @cached_property
    def dates(self) -> DataFrame:
        return spines.dates_spine(self.spark, self.params)

    @cached_property
    def months(self) -> DataFrame:
        return spines.months_spine(self.spark, self.params)

    # the same spines over the days that the log has
    @cached_property
    def log_bounds(self) -> DataFrame:
        return spines.log_bounds(self.staged, self.params)

    @cached_property
    def log_numbers(self) -> DataFrame:
        return spines.numbers_between(self.log_bounds)

    @cached_property
    def log_dates(self) -> DataFrame:
        return spines.dates_between(self.log_bounds)

    @cached_property
    def log_months(self) -> DataFrame:
        return spines.months_of(self.log_dates)

    # dimensions ----------------------------------------------------------
    @cached_property
    def species(self) -> DataFrame:
        return dims.species(self.staged, self.params)

    @cached_property
    def species_to_locations(self) -> DataFrame:
        return dims.species_to_locations(self.staged)

    @cached_property
    def species_to_locations_by_key(self) -> DataFrame:
        return dims.species_to_locations_by_key(self.staged)

    # rollups ---------------------------------------------------------------
    @cached_property
    def daily_summary(self) -> DataFrame:
        return rollups.daily_summary(self.staged, self.dates, self.params)

    @cached_property
    def monthly_summary(self) -> DataFrame:
        return rollups.monthly_summary(self.staged, self.months, self.params)

    @cached_property
    def day_of_week_summary(self) -> DataFrame:
        return rollups.day_of_week_summary(self.staged, self.params)

    # panels (unsorted: hash-partitioned by entity, for downstream reuse) ---
    @cached_property
    def daily_species_panel(self) -> DataFrame:
        return panel.panel(self.species_facts, self.species, panel.DAILY_SPECIES, self.params)

    @cached_property
    def monthly_species_counts(self) -> DataFrame:
        return panel.grid_counts(self.species_facts, self.species, panel.MONTHLY_SPECIES, self.params)

    @cached_property
    def monthly_species_panel(self) -> DataFrame:
        return panel.panel(self.species_facts, self.species, panel.MONTHLY_SPECIES, self.params)

    @property
    def location_facts(self) -> DataFrame:
        # the panel derives species_location_id after aggregating the facts
        return self.species_facts

    @cached_property
    def location_entities(self) -> DataFrame:
        return self.species_to_locations_by_key.withColumnRenamed("id", "species_location_id")

    @cached_property
    def monthly_species_location_panel(self) -> DataFrame:
        return panel.panel(self.location_facts, self.location_entities, panel.MONTHLY_SPECIES_LOCATION, self.params)

    @property
    def daily_species_summary(self) -> DataFrame:
        return panel.ordered(self.daily_species_panel, panel.DAILY_SPECIES, self.params)

    @property
    def monthly_species_summary(self) -> DataFrame:
        return panel.ordered(self.monthly_species_panel, panel.MONTHLY_SPECIES, self.params)

    @property
    def monthly_species_summary_by_location(self) -> DataFrame:
        return panel.ordered(self.monthly_species_location_panel, panel.MONTHLY_SPECIES_LOCATION, self.params)

    @cached_property
    def weekly_species_summary(self) -> DataFrame:
        return rollups.weekly_species_summary(self.daily_species_panel)

    # forecast inputs ---------------------------------------------------------
    @cached_property
    def forecast_prep_species(self) -> DataFrame:
        return forecast.prep(
            self.monthly_species_panel, "taxon_id", self.params.min_total_species, self.params
        )

    @cached_property
    def forecast_prep_species_location(self) -> DataFrame:
        return forecast.prep(
            self.monthly_species_location_panel, "species_location_id",
            self.params.min_total_species_location, self.params,
        )
