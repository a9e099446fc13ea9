"""Audits and lenient reading, proven order, and states that increments are merged into."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.functions import month_key, parse_int_array
from fieldnotes.operators import distinct_state, incremental, membership, ordering, rejects
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import models, register
from fieldnotes.session import kept
from fieldnotes.sources import landing_audit
from fieldnotes.sources.testpages import PER_PAGE
from fieldnotes.sources.testdata import raw_observations

# --- pages that did not land: of each place's pull two pages in seven, and the last page of the first place

LOST = f"(page % 7 IN (3, 4) OR (place_id = {P.places[0]} AND page = num_pages))"
O.cte("pull_pages", f"""
SELECT *, CAST(unnest(generate_series(1, num_pages)) AS BIGINT) AS page FROM (
  SELECT place_id, count(*) // {PER_PAGE} + 1 AS num_pages FROM landed GROUP BY 1) t""", "landed")


@register("landing_missing_pages", O.sql(f"""
SELECT place_id, min(page) AS first_page, max(page) AS last_page, count(*) AS num_pages FROM (
  SELECT place_id, page, page - row_number() OVER (PARTITION BY place_id ORDER BY page) AS island FROM pull_pages WHERE {LOST}) t
GROUP BY place_id, island""", "pull_pages"))
def landing_missing_pages(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    seen = F.array_intersect(parse_int_array("place_ids"), F.array(*[F.lit(p) for p in P.places]))
    pulls = raw.select(F.explode(seen).alias("place_id")).groupBy("place_id").agg(F.count("*").alias("total_results"))
    pages = pulls.withColumn("num_pages", F.expr(f"total_results div {PER_PAGE} + 1"))
    pages = pages.select("place_id", "total_results", "num_pages", F.explode(F.expr("sequence(1L, num_pages)")).alias("page")).where(f"NOT {LOST}")
    return landing_audit.missing_pages(pages.withColumn("per_page", F.lit(PER_PAGE)))


# --- rejected rows: some places and some coordinates are no numbers

BAD_LOCATION, BAD_PLACES = "inaturalist_id % 97 = 0", "inaturalist_id % 89 = 0"
O.cte("dirty", f"""
SELECT * REPLACE (CASE WHEN {BAD_LOCATION} THEN '45.1,n/a' ELSE location END AS location,
                  CASE WHEN {BAD_PLACES} THEN '{{x,2}}' ELSE place_ids END AS place_ids) FROM raw""", "raw")
O.cte("rated", """
SELECT *, CASE
  WHEN len(list_filter(string_split(location, ','), lambda x: TRY_CAST(x AS DECIMAL(12,6)) IS NULL)) > 0 THEN 'location is not a list of numbers'
  WHEN len(list_filter(string_split(trim(place_ids, '{}'), ','), lambda x: TRY_CAST(x AS INTEGER) IS NULL)) > 0 THEN 'place_ids is not a list of whole numbers'
END AS reason FROM dirty""", "dirty")
O.cte("clean", "SELECT * EXCLUDE (reason) FROM rated WHERE reason IS NULL", "rated")
O.staged_ctes("stg_clean", "clean")


def _dirty(spark, sf_dir) -> DataFrame:
    raw = raw_observations(spark, sf_dir, P)
    return raw.withColumns({"location": F.when(F.expr(BAD_LOCATION), "45.1,n/a").otherwise(F.col("location")),
                            "place_ids": F.when(F.expr(BAD_PLACES), "{x,2}").otherwise(F.col("place_ids"))})


@register("staging_rejected", O.sql(
    f"SELECT id, location, place_ids, reason FROM rated WHERE reason IS NOT NULL AND observed_date >= {O.ts(P.epoch)}", "rated"))
def staging_rejected(spark, sf_dir):
    return rejects.stage_lenient(_dirty(spark, sf_dir), P)[1].select("id", "location", "place_ids", "reason")


@register("staging_lenient", O.sql("SELECT * REPLACE (CAST(coordinates AS VARCHAR[]) AS coordinates) FROM stg_clean", "stg_clean"))
def staging_lenient(spark, sf_dir):
    return rejects.stage_lenient(_dirty(spark, sf_dir), P)[0].withColumn("coordinates", F.col("coordinates").cast("array<string>"))


# --- the order of the models' rows, NULL last and by a column that is not returned


@register("order_daily_summary", O.sql("SELECT count(*) AS num_rows, CAST(0 AS BIGINT) AS num_violations FROM daily_summary", "daily_summary"))
def order_daily_summary(spark, sf_dir):
    return ordering.order_violations(models(spark, sf_dir).daily_summary, "date_day_observed")


@register("order_species_location_panel", O.sql(
    "SELECT count(*) AS num_rows, CAST(0 AS BIGINT) AS num_violations FROM monthly_species_summary_by_location", "monthly_species_summary_by_location"))
def order_species_location_panel(spark, sf_dir):
    return ordering.order_violations(models(spark, sf_dir).monthly_species_summary_by_location, "date_month_observed")


@register("order_day_of_week", O.sql("SELECT count(*) AS num_rows, CAST(0 AS BIGINT) AS num_violations FROM day_of_week_summary", "day_of_week_summary"))
def order_day_of_week(spark, sf_dir):
    place = F.expr("array_position(array('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'), _day_of_week)")
    return ordering.order_violations(models(spark, sf_dir).day_of_week_summary, place)


# --- states that an increment is merged into


@register("agg_count_distinct_merged", O.sql("""
SELECT taxon_id, CAST(date_trunc('month', observed_date) AS TIMESTAMP) AS date_month, COUNT(DISTINCT inaturalist_id) AS num_distinct_observations
FROM raw GROUP BY 1, 2""", "raw"))
def agg_count_distinct_merged(spark, sf_dir):
    """Distinct observations per taxon and month: the state of the first load merged with that of the pull after it."""
    raw = raw_observations(spark, sf_dir, P).withColumn("date_month", month_key("observed_date"))
    keys = ["taxon_id", "date_month"]
    stored = raw.where(F.col("updated_at") < F.lit(P.first_load_before).cast("timestamp_ntz"))
    fetched = incremental.updated_since(raw, incremental.high_water_mark(stored))
    states = [distinct_state.state_of(x, keys, "inaturalist_id") for x in (stored, fetched)]
    state = reduce(lambda a, b: distinct_state.merged(a, b, keys), states)
    return distinct_state.counts(state, keys, "num_distinct_observations")


@register("ingest_new_rows_by_sketch", O.sql("SELECT * FROM new_rows", "new_rows"))
def ingest_new_rows_by_sketch(spark, sf_dir):
    raw = kept(raw_observations(spark, sf_dir, P), "log")
    stored = raw.where(F.col("updated_at") < F.lit(P.first_load_before).cast("timestamp_ntz"))
    fetched = incremental.updated_since(raw, incremental.high_water_mark(stored))
    return membership.new_rows(fetched, stored, membership.sketch(stored))
