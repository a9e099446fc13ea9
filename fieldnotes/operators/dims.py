"""Species and species-location dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.functions import surrogate_key
from fieldnotes.operators.staging import species_level
from fieldnotes.params import Params

SPECIES_KEYS = ("taxon_id", "latin_name", "preferred_common_name")


def species(staged: DataFrame, params: Params) -> DataFrame:
    """One row per (taxon, latin name, common name) of species-level facts."""
    dates = (F.max("date_day_observed").alias("most_recent_observed_date"), F.min("date_day_observed").alias("first_observed_date"))
    # dates per (keys, rank, url) by hash; the maxima of the texts then run over those few rows
    each = species_level(staged, params).groupBy(*SPECIES_KEYS, "rank", "wikipedia_url").agg(*dates)
    spans = each.groupBy(*SPECIES_KEYS).agg(
        F.max("most_recent_observed_date").alias("most_recent_observed_date"), F.min("first_observed_date").alias("first_observed_date"),
        F.collect_set("rank").alias("_ranks"), F.collect_set("wikipedia_url").alias("_urls"))
    return spans.select(*SPECIES_KEYS, "most_recent_observed_date", "first_observed_date",
                        F.array_max("_ranks").alias("rank"), F.array_max("_urls").alias("wikipedia_url"))


def species_to_locations(staged: DataFrame) -> DataFrame:
    """Species-location pairs, with first/last dates taken per observation row.

    Faithful to the reference: its window is partitioned by the staging row
    id, so each output row carries the dates of one observation version and a
    pair repeats once per distinct date. The facts are folded per (id,
    attributes, day) and dealt out by id once; the window and the distinct
    pairs follow on that layout.
    """
    attrs = ["location_id", "taxon_id", "latin_name", "preferred_common_name"]
    rows = staged.repartition("id").groupBy("id", *attrs).agg(F.max("date_day_observed").alias("_last"), F.min("date_day_observed").alias("_first"))
    same = Window.partitionBy("id")
    pairs = rows.select(*attrs, F.max("_last").over(same).alias("most_recent_observation_date"),
                        F.min("_first").over(same).alias("first_observation_date")).distinct()
    return pairs.select(surrogate_key("taxon_id", "location_id").alias("id"), *pairs.columns)


def species_to_locations_by_key(staged: DataFrame) -> DataFrame:
    """One row per species-location pair (and name), dates over the pair.

    The surrogate key is a function of (taxon, location), so it is computed
    after the grouping: once per pair instead of once per observation.
    """
    return (
        staged.groupBy("location_id", "taxon_id", "latin_name", "preferred_common_name")
        .agg(
            F.max("date_day_observed").alias("most_recent_observation_date"),
            F.min("date_day_observed").alias("first_observation_date"),
        )
        .select(
            surrogate_key("taxon_id", "location_id").alias("id"), "location_id", "taxon_id", "latin_name",
            "preferred_common_name", "most_recent_observation_date", "first_observation_date",
        )
    )
