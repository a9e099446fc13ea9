"""Landed pages of the observations API: reading, parsing, flattening.

A page is one JSON document per line (schema ``RAW_API``) with a
``results`` array of at most ``per_page`` observations. The reader never
infers a schema, and the flatten step is null-safe: a missing or null
``observed_on_details`` or ``taxon`` gives NULL fields, not an error.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.functions import parse_int_array, row_id
from fieldnotes.schemas import RAW_API, RAW_OBSERVATION, conform

def read_pages(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Landed pages with the fixed ``RAW_API`` schema (no inference). A line that is no page ends the job.

    With ``since`` and a landing partitioned by ``load_date``, only folders
    landed on or after that day are listed and read (a partition filter).
    """
    return landed_since(spark.read.schema(RAW_API).option("mode", "FAILFAST").json(path), since)


def read_page_texts(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The landed lines as they are (value), for a reader that sorts out what is no page."""
    return landed_since(spark.read.text(path), since)


def landed_since(landed: DataFrame, since: dt.date | None) -> DataFrame:
    return landed.where(F.col("load_date") >= F.lit(since)) if since is not None and "load_date" in landed.columns else landed


def parse_pages(json_text: DataFrame, col: str = "value") -> DataFrame:
    """Parse JSON page text already in a DataFrame."""
    parsed = json_text.select(F.from_json(F.col(col), RAW_API).alias("p"))
    return parsed.select("p.*")


def explode_results(pages: DataFrame) -> DataFrame:
    """One row per result, keeping the page's place."""
    return pages.select("place_id", F.explode("results").alias("r"))


def wild(results: DataFrame, captive: bool = False) -> DataFrame:
    """Exploded results without those that say the opposite of ``captive``; results that do not say stay."""
    return results.where(F.coalesce(F.col("r.captive"), F.lit(captive)) == F.lit(captive))


OFFSET_SUFFIX = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def utc_wall_clock(text: F.Column, session_tz: str) -> F.Column:
    """ISO text to a UTC wall-clock TIMESTAMP_NTZ, whatever the session zone.

    Text with an offset is an instant: parsed, then moved from the session
    zone to UTC. Text without one is already UTC wall clock.
    """
    instant = F.convert_timezone(F.lit(session_tz), F.lit("UTC"), F.to_timestamp(text).cast("timestamp_ntz"))
    return F.when(text.rlike(OFFSET_SUFFIX), instant).otherwise(F.to_timestamp_ntz(text))


def flatten_results(results: DataFrame, loaded_on: dt.date) -> DataFrame:
    """Null-safe flatten of exploded results to the raw log schema.

    Field access on a NULL struct yields NULL, so a missing or null
    ``observed_on_details`` or ``taxon`` gives NULL columns. Times are parsed
    to UTC wall clock (session time zone UTC); the row id and load stamp are
    added here.
    """
    r = "r"
    session_tz = results.sparkSession.conf.get("spark.sql.session.timeZone")
    det = f"{r}.observed_on_details"
    tax = f"{r}.taxon"
    flat = results.select(
        F.col(f"{r}.id").alias("inaturalist_id"),
        F.col(f"{tax}.id").alias("taxon_id"),
        F.col(f"{tax}.name").alias("name"),
        F.col(f"{tax}.preferred_common_name").alias("preferred_common_name"),
        F.to_date(F.col(f"{det}.date")).cast("timestamp_ntz").alias("observed_date"),
        F.col(f"{det}.month").cast("double").alias("observed_month"),
        F.col(f"{det}.hour").cast("double").alias("observed_hour"),
        F.col(f"{det}.week").cast("double").alias("observed_week"),
        F.col(f"{det}.year").cast("double").alias("observed_year"),
        F.col(f"{det}.day").cast("double").alias("observed_day"),
        utc_wall_clock(F.col(f"{r}.updated_at"), session_tz).alias("updated_at"),
        F.col(f"{r}.species_guess").alias("species_guess"),
        F.when(F.col(f"{r}.place_ids").isNotNull(), F.concat(
            F.lit("{"), F.array_join(F.col(f"{r}.place_ids").cast("array<string>"), ","), F.lit("}")
        )).alias("place_ids"),
        F.col(f"{r}.location").alias("location"),
        F.col(f"{tax}.endemic").alias("endemic"),
        F.col(f"{tax}.native").alias("native"),
        F.col(f"{tax}.introduced").alias("introduced"),
        F.col(f"{tax}.threatened").alias("threatened"),
        F.col(f"{tax}.rank").alias("rank"),
        F.col(f"{tax}.wikipedia_url").alias("wikipedia_url"),
        F.col(f"{r}.out_of_range").alias("out_of_range"),
        F.col(f"{r}.identifications_most_disagree").alias("identifications_most_disagree"),
        F.lit(loaded_on).alias("_data_loaded_date"),
    )
    return conform(flat.withColumn("id", row_id()), RAW_OBSERVATION)


def source_filter(raw: DataFrame, place_id: int | None = None, updated_since: F.Column | dt.date | None = None,
                  taxon_ids: tuple[int, ...] | None = None, captive: bool | None = None,
                  place_ids: tuple[int, ...] | None = None) -> DataFrame:
    """The API's request predicates applied to landed rows.

    ``place_id`` matches any entry of ``place_ids`` (``place_ids``: any of several);
    ``updated_since`` keeps rows updated on or after that day; ``captive`` drops rows
    that say the opposite, and keeps those that do not say.
    """
    out = raw
    if captive is not None and "captive" in raw.columns:
        out = out.where(F.coalesce(F.col("captive"), F.lit(captive)) == F.lit(captive))
    if place_id is not None:
        out = out.where(F.array_contains(parse_int_array("place_ids"), F.lit(place_id)))
    if place_ids:
        out = out.where(F.arrays_overlap(parse_int_array("place_ids"), F.array(*[F.lit(p) for p in place_ids])))
    if updated_since is not None:
        since = updated_since if isinstance(updated_since, F.Column) else F.lit(updated_since)
        out = out.where(F.col("updated_at") >= since.cast("timestamp_ntz"))
    if taxon_ids:
        out = out.where(F.col("taxon_id").isin(*taxon_ids))
    return out
