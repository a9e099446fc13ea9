"""Test pages: raw observations of the test tables rendered as pages of the API, and landed.

What a client would fetch and land; the engine itself only reads landed pages (``api_pages``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.functions import parse_int_array
from fieldnotes.schemas import RAW_API

PER_PAGE = 100  # rows per page, the API's page size


def _iso(col: str) -> F.Column:
    return F.date_format(F.col(col), "yyyy-MM-dd'T'HH:mm:ss")


def pages_from_observations(raw: DataFrame, place_id: int, per_page: int = PER_PAGE) -> DataFrame:
    """Render raw observation versions seen at ``place_id`` as API pages.

    Pages are cut inside each input partition (``monotonically_increasing_id``
    is partition-local), so a page never holds more than ``per_page`` rows,
    however the ids are distributed.
    """
    at_place = raw.where(F.array_contains(parse_int_array("place_ids"), F.lit(place_id)))
    result = F.struct(
        F.col("inaturalist_id").alias("id"),
        "species_guess",
        "location",
        parse_int_array("place_ids").alias("place_ids"),
        _iso("updated_at").alias("updated_at"),
        "out_of_range",
        "identifications_most_disagree",
        F.lit(False).alias("captive"),
        F.struct(
            F.date_format("observed_date", "yyyy-MM-dd").alias("date"),
            F.col("observed_month").cast("int").alias("month"),
            F.col("observed_hour").cast("int").alias("hour"),
            F.col("observed_week").cast("int").alias("week"),
            F.col("observed_year").cast("int").alias("year"),
            F.col("observed_day").cast("int").alias("day"),
        ).alias("observed_on_details"),
        F.struct(
            F.col("taxon_id").alias("id"), "name", "rank", "preferred_common_name", "wikipedia_url",
            "endemic", "native", "introduced", "threatened",
        ).alias("taxon"),
    )
    page_no = (F.monotonically_increasing_id() / per_page).cast("long")
    return (
        at_place.select(F.spark_partition_id().alias("_part"), page_no.alias("_page"), result.alias("r"))
        .groupBy("_part", "_page")
        .agg(F.collect_list("r").alias("results"))
        .select(
            F.lit(None).cast("long").alias("total_results"),
            F.lit(None).cast("int").alias("page"),
            F.lit(per_page).alias("per_page"),
            F.lit(place_id).alias("place_id"),
            "results",
        )
    )


def pages_as_json(pages: DataFrame) -> DataFrame:
    """One JSON text per page (the landed form)."""
    return pages.select(F.to_json(F.struct(*[F.col(f.name) for f in RAW_API.fields])).alias("value"))


def land_pages(pages: DataFrame, path: str, mode: str = "append", load_date: dt.date | None = None) -> None:
    """Write pages as JSON lines (gzip); with ``load_date``, under ``load_date=YYYY-MM-DD``
    so that later pulls can skip older landings by partition pruning."""
    target = f"{path.rstrip('/')}/load_date={load_date.isoformat()}" if load_date else path
    pages_as_json(pages).write.mode(mode).option("compression", "gzip").text(target)
