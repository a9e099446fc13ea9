"""The four incremental models maintained by change set, and models kept in the catalog (S13, S17)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldnotes.operators import incremental
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans import catalog
from fieldnotes.plans import oracle as O
from fieldnotes.plans.base import Query, models, register
from fieldnotes.plans.maintenance import MODELS, Maintained
from fieldnotes.session import kept, scratch_path
from fieldnotes.sources.testdata import raw_observations

PARTS = 8


def _maintained(name: str) -> Query:
    def run(spark, sf_dir):
        raw = kept(raw_observations(spark, sf_dir, P), "log")
        stored = incremental.dedupe_by_key(raw.where(F.col("updated_at") < F.lit(P.first_load_before).cast("timestamp_ntz")))
        fetched = incremental.updated_since(raw, incremental.high_water_mark(stored))
        tables = Maintained(spark, scratch_path(spark, "maintained"), P, PARTS, (name,))
        tables.run(stored)
        tables.run(incremental.dedupe_by_key(fetched))  # rows that are staged already are left out
        return tables.read(name)
    run.__name__ = f"maintain_{name}"
    return run


for _name in MODELS:
    register(f"maintain_{_name}", O.model(f"{_name}_increment"))(_maintained(_name))


def _from_catalog(build, kinds):
    def run(spark, sf_dir):
        m, prefix = models(spark, sf_dir), f"t{uuid.uuid4().hex[:8]}_"
        catalog.materialise(m, kinds, prefix, PARTS, scratch_path(spark, "catalog"))
        return build(m, prefix)
    return run


register("catalog_weekly_species_summary", O.model("weekly_species_summary"))(
    _from_catalog(catalog.weekly_species_summary, {"species_day": "table"}))
register("catalog_monthly_species_summary", O.model("monthly_species_summary"))(
    _from_catalog(catalog.monthly_species_summary, {"species_month_counts": "table"}))
