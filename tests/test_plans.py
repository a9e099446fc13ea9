"""Plan-shape checks: the properties the jobs rely on at scale."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from fieldnotes.operators import versions
from fieldnotes.plans import jobs
from fieldnotes.plans.registry import QUERIES
from fieldnotes.params import FIXTURE_PARAMS as P

from tests.support import SMOKE_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_bound_reaches_the_scan(spark):
    text = plan(QUERIES["stg_observations"](spark, SMOKE_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", text) or \
        "GreaterThanOrEqual(l_shipdate" in text


def test_rollups_have_no_expand(spark):
    for name in ("daily_summary", "monthly_summary", "agg_conditional_distinct"):
        assert "Expand" not in plan(QUERIES[name](spark, SMOKE_DIR)), name


def test_panels_generate_the_grid_and_reuse_one_partitioning(spark):
    for name in ("daily_species_summary", "monthly_species_summary", "monthly_species_summary_by_location"):
        df = QUERIES[name](spark, SMOKE_DIR)
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Generate" in text, name
        # windows, the per-cell sum and the union share one partitioning: no exchange between them
        window_to_union = text[text.index("Window"):text.index("Union", text.index("Window"))]
        assert "Exchange" not in window_to_union, name


def test_location_dimension_scans_the_facts_once(spark):
    text = plan(QUERIES["species_to_locations"](spark, SMOKE_DIR))
    assert text.count("l_shipdate") and sum("Scan parquet" in x and "l_orderkey" in x for x in text.splitlines()) <= 1


def test_species_dimension_and_forecast_stay_in_built_ins(spark):
    assert "SortAggregate" not in plan(QUERIES["species_dim"](spark, SMOKE_DIR))
    text = plan(QUERIES["forecast_all"](spark, SMOKE_DIR))
    assert "Pandas" not in text and "Python" not in text and "Arrow" not in text


def test_grid_is_generated(spark):
    text = plan(QUERIES["grid_cross_join"](spark, SMOKE_DIR))
    assert "Generate" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_a_merge_is_written_once_and_seen_when_committed(spark, monkeypatch):
    """A run that dies between its files and its commit changes nothing, and the next one is right."""
    path = os.path.join(tempfile.mkdtemp(prefix="merge-"), "t")
    make = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    assert sorted(map(tuple, jobs._store(spark, path, make((1, "a"), (2, "b")), ["k"]).collect())) == [(1, "a"), (2, "b")]
    seen = jobs._store(spark, path, make((2, "B")), ["k"])
    table = versions.PartTable(spark, path)
    # the files of a third version, without its commit
    make((9, "z")).withColumn(versions.PART, F.lit(0)).write.partitionBy(versions.PART).parquet(table.folder(3))
    assert sorted(map(tuple, table.read(seen.schema).collect())) == [(1, "a"), (2, "B")]
    after = jobs._store(spark, path, make((3, "c")), ["k"])
    assert sorted(map(tuple, after.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, seen.collect())) == [(1, "a"), (2, "B")]  # who reads the version before still can
    files = [f for d, _, names in os.walk(os.path.join(path, "data")) for f in names if f.endswith(".parquet") and os.path.getsize(os.path.join(d, f)) > 600]
    assert len({f for f in files}) == len(files)  # nothing is a copy
    jobs._store(spark, path, make((4, "d")))
    assert sorted(map(tuple, table.read(seen.schema).collect())) == [(4, "d")]
    assert {v.version for v in table.versions()} - table.emptied() == {3, 4}
