"""The three jobs end to end: land pages from the tables, ingest twice,
transform, forecast."""

import os
import tempfile

from pyspark.sql import functions as F

from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import jobs
from fieldnotes.sources import testpages
from fieldnotes.sources.testdata import raw_observations

from tests.support import SMOKE_DIR


def test_ingest_transform_forecast(spark):
    base = tempfile.mkdtemp(prefix="jobs-")
    landing, warehouse = os.path.join(base, "landing"), os.path.join(base, "warehouse")
    raw = raw_observations(spark, SMOKE_DIR, P)
    for place in P.places:
        testpages.land_pages(testpages.pages_from_observations(raw, place), landing)
    distinct_ids = raw.where(F.expr("arrays_overlap(transform(split(btrim(place_ids, '{}'), ','), x -> cast(x as int)), "
                                    f"array({', '.join(str(p) for p in P.places)}))")).select("id").distinct().count()
    assert jobs.ingest(spark, landing, P, warehouse) == distinct_ids
    assert jobs.ingest(spark, landing, P, warehouse) == 0  # same pages again: nothing new

    stored = jobs.transform(spark, P, warehouse)
    assert set(jobs.TRANSFORM_MODELS) <= set(stored)
    monthly, species = stored["monthly_species_summary"], stored["species"]
    months = monthly.select("date_month_observed").distinct().count()
    n_monthly, n_species = monthly.count(), species.count()
    assert n_monthly == months * n_species  # dense grid
    merged = ["species", "species_to_locations", "monthly_species_summary", "monthly_species_summary_by_location"]
    before = {m: sorted(map(str, stored[m].collect())) for m in merged}
    jobs.transform(spark, P, warehouse, only=merged)  # a re-run merges by key and changes nothing
    for m in merged:
        assert sorted(map(str, jobs.stored_model(spark, m, warehouse).read(stored[m].schema).collect())) == before[m], m

    for model in ("seasonal_naive", "grouped", "order_search"):
        n = jobs.forecast(spark, P, warehouse, model=model)
        assert n > 0 and jobs.forecast(spark, P, warehouse, model=model) == n  # a repeated run replaces its rows
    assert jobs.stored_forecasts(spark, warehouse).count() == 2 * n
