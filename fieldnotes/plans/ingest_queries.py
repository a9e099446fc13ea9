"""Ingest queries: landed pages, incremental pulls, sinks
and the streaming ingest, all fed from the raw log derived from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.operators import dims, incremental, staging
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import register
from fieldnotes.schemas import RAW_OBSERVATION
from fieldnotes.session import kept, scratch_path
from fieldnotes.sources import api_pages, testpages
from fieldnotes.sources.testdata import events, raw_observations
from fieldnotes.streaming import ingest as streaming


def _pages_text(raw: DataFrame, place: int) -> DataFrame:
    """Landed JSON text of every page of one place."""
    return testpages.pages_as_json(testpages.pages_from_observations(raw, place))


def _landed(spark, sf_dir) -> DataFrame:
    """Every landed page of every place, parsed and exploded (one row per result)."""
    raw = raw_observations(spark, sf_dir, P)
    pages = reduce(DataFrame.unionByName, [_pages_text(raw, p) for p in P.places])
    return api_pages.explode_results(api_pages.parse_pages(pages))


def _scenario(spark, sf_dir):
    """First load (stored) and the pull from its high-water mark (fetched), of a log that is built once."""
    raw = kept(raw_observations(spark, sf_dir, P), "log")
    stored = raw.where(F.col("updated_at") < F.lit(P.first_load_before).cast("timestamp_ntz"))
    hwm = incremental.high_water_mark(stored)
    fetched = incremental.updated_since(raw, hwm)
    return stored, hwm, fetched


@register("ingest_explode", O.sql(
    "SELECT place_id, inaturalist_id, taxon_id, updated_at FROM landed", "landed"))
def ingest_explode(spark, sf_dir):
    landed = _landed(spark, sf_dir)
    return landed.select(
        "place_id",
        F.col("r.id").alias("inaturalist_id"),
        F.col("r.taxon.id").alias("taxon_id"),
        api_pages.utc_wall_clock(F.col("r.updated_at"), spark.conf.get("spark.sql.session.timeZone"))
        .alias("updated_at"),
    )


@register("ingest_flatten_pages", O.sql("SELECT * EXCLUDE (place_id) FROM landed", "landed"))
def ingest_flatten_pages(spark, sf_dir):
    return api_pages.flatten_results(_landed(spark, sf_dir), P.as_of)


@register("ingest_flatten_json", O.sql(
    "SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"))
def ingest_flatten_json(spark, sf_dir):
    parsed = events(spark, sf_dir).select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", "event_type", F.col("p.k").alias("k"))


SOURCE_TAXA = tuple(range(11, 56, 2))  # the taxa of the test mapping with an odd number


@register("ingest_source_filter", O.sql(f"""
SELECT id, inaturalist_id, place_ids, updated_at FROM raw
WHERE list_contains({O.PLACE_ARRAY}, {P.places[0]}) AND updated_at >= {O.ts(P.source_updated_since)}
  AND taxon_id IN {SOURCE_TAXA}""", "raw"))
def ingest_source_filter(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    return api_pages.source_filter(raw, place_id=P.places[0], updated_since=P.source_updated_since, taxon_ids=SOURCE_TAXA, captive=False).select(
        "id", "inaturalist_id", "place_ids", "updated_at")


@register("ingest_row_id", O.sql(
    "SELECT inaturalist_id, updated_at, name, id, _data_loaded_date FROM raw", "raw"))
def ingest_row_id(spark, sf_dir):
    return raw_observations(spark, sf_dir, P).select("inaturalist_id", "updated_at", "name", "id", "_data_loaded_date")


@register("ingest_high_water_mark", O.sql("SELECT * FROM hwm", "hwm"))
def ingest_high_water_mark(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    return incremental.high_water_mark(raw.where(F.col("updated_at") < F.lit(P.first_load_before).cast("timestamp_ntz")))


@register("ingest_new_rows_anti_join", O.sql("SELECT * FROM new_rows", "new_rows"))
def ingest_new_rows_anti_join(spark, sf_dir):
    stored, _, fetched = _scenario(spark, sf_dir)
    return incremental.new_rows(fetched, stored)


@register("upsert_by_key", O.sql("""
SELECT * FROM species_new
UNION ALL
SELECT * FROM species_stored t WHERE NOT EXISTS (SELECT 1 FROM species_new n WHERE n.taxon_id = t.taxon_id)""",
    "species_new", "species_stored"))
def upsert_by_key(spark, sf_dir):
    stored, _, fetched = _scenario(spark, sf_dir)
    fresh = incremental.new_rows(fetched, stored)
    target = dims.species(staging.stage_observations(stored, P), P)
    updates = dims.species(staging.stage_observations(fresh, P), P)
    return incremental.upsert(target, updates, ["taxon_id"])


@register("ingest_union_places", O.sql("SELECT * FROM landed_union", "landed_union"))
def ingest_union_places(spark, sf_dir):
    raw = raw_observations(spark, sf_dir, P)
    per_place = [
        api_pages.flatten_results(
            api_pages.explode_results(api_pages.parse_pages(_pages_text(raw, p))), P.as_of)
        for p in P.places
    ]
    return incremental.dedupe_by_key(reduce(DataFrame.unionByName, per_place))


@register("append_sink", O.sql(
    "SELECT * FROM stored_dedup UNION ALL SELECT * FROM new_rows", "stored_dedup", "new_rows"))
def append_sink(spark, sf_dir):
    """First load, then the increment twice: the replay appends nothing."""
    stored, _, fetched = _scenario(spark, sf_dir)
    path = scratch_path(spark, "observations")
    incremental.load_increment(spark, stored, path, RAW_OBSERVATION)
    incremental.load_increment(spark, fetched, path, RAW_OBSERVATION)
    incremental.load_increment(spark, fetched, path, RAW_OBSERVATION)
    return spark.read.schema(incremental.with_month_schema(RAW_OBSERVATION)).parquet(path).select(*RAW_OBSERVATION.names)


def _land_all(spark, sf_dir) -> str:
    raw = kept(raw_observations(spark, sf_dir, P), "log")
    landing = scratch_path(spark, "landing")
    for p in P.places:
        testpages.land_pages(testpages.pages_from_observations(raw, p), landing)
    return landing


@register("stream_ingest_available_now", O.sql("SELECT * FROM landed_union", "landed_union"))
def stream_ingest_available_now(spark, sf_dir):
    landing = _land_all(spark, sf_dir)
    target = scratch_path(spark, "stream-log")
    streaming.ingest_available_now(spark, landing, target, scratch_path(spark, "stream-ckpt"), P.as_of,
                                   max_files_per_trigger=4)
    return streaming.read_log(spark, target)


@register("stream_dedupe", O.sql("SELECT * FROM landed_union", "landed_union"))
def stream_dedupe(spark, sf_dir):
    landing = _land_all(spark, sf_dir)
    return streaming.dedupe_stream(spark, landing, scratch_path(spark, "stream-dedupe"),
                                   scratch_path(spark, "stream-dedupe-ckpt"), P.as_of, max_files_per_trigger=64)
