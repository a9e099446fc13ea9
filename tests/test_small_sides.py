"""Joins with a small side move no rows of the large one, whatever the planner's setting; without it the rows are the same."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from fieldnotes import session
from fieldnotes.operators import incremental
from fieldnotes.params import FIXTURE_PARAMS
from fieldnotes.plans.registry import QUERIES
from fieldnotes.schemas import RAW_OBSERVATION
from fieldnotes.sources.testdata import raw_observations
from fieldnotes.streaming import ingest as streaming
from tests.support import SMOKE_DIR, raw_row, ts
from tests.test_plans import plan


@pytest.fixture
def no_threshold(spark):
    """The planner takes no table for small by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def rows(df):
    return sorted(map(str, df.collect()))


def log(raw_df):
    """Ids 0 to 19; the even ones have two unlike rows, and there is a row without an id twice."""
    once = raw_df([raw_row(inaturalist_id=i) for i in range(20)])
    other = raw_df([raw_row(inaturalist_id=i, species_guess="a") for i in range(0, 20, 2)])
    none = other.limit(1).withColumn("id", F.lit(None).cast("string"))
    return once.unionByName(other).unionByName(none).unionByName(none)


def test_line_items_are_moved_once(spark, no_threshold):
    text = plan(raw_observations(spark, SMOKE_DIR, FIXTURE_PARAMS).select("inaturalist_id", "taxon_id", "species_guess", "updated_at"))
    assert text.count("SortMergeJoin") == 1 and text.count("hashpartitioning") == 2


def test_repeated_keys_are_sent_to_the_rows(spark, raw_df, no_threshold):
    df = session.kept(log(raw_df), "log")
    text = plan(incremental.dedupe_by_key(df))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    stored = df.where("inaturalist_id < 5")
    assert plan(incremental.new_rows(df, stored)).count("SortMergeJoin") == 0


def test_too_many_repeats_give_the_same_rows(raw_df, monkeypatch):
    df = session.kept(log(raw_df), "log")
    few = rows(incremental.dedupe_by_key(df))
    assert len(few) == 21
    monkeypatch.setattr(incremental, "SENT", 0)
    many = incremental.dedupe_by_key(df)
    assert rows(many) == few and many.columns == df.columns and "LeftAnti" not in plan(many)


@pytest.mark.parametrize("most", [0, 1 << 21])
def test_copies_of_a_batch_whatever_is_sent(spark, raw_df, monkeypatch, no_threshold, most):
    monkeypatch.setattr(streaming, "SENT", most)
    monkeypatch.setattr(session, "SENT", most)
    target = tempfile.mkdtemp(prefix="copies-") + "/log"
    batch = session.kept(log(raw_df).unionByName(log(raw_df)), "batch")
    session.write_folders(streaming.fresh_copies(batch, target), target, "append", incremental.MONTH)
    assert spark.read.parquet(target).count() == 31
    more = session.kept(log(raw_df).unionByName(raw_df([raw_row(inaturalist_id=90)])), "batch")
    fresh = streaming.fresh_copies(more, target)
    if most:
        assert "SortMergeJoin" not in plan(fresh)
    assert [r.inaturalist_id for r in fresh.where("id IS NOT NULL").collect()] == [90]


def test_folders_are_written_side_by_side(spark, raw_df, monkeypatch):
    name, seen, plain = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name)

    def parquet(self, *a, **kw):
        seen.append(int(spark.conf.get(name)))
        return plain(self, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    path = tempfile.mkdtemp(prefix="folders-") + "/log"
    df = incremental.with_month(raw_df([raw_row(inaturalist_id=i, updated_at=ts(f"2001-0{1 + i % 9}-05 08:00:00")) for i in range(30)]))
    incremental.append(df, path, [incremental.MONTH])
    assert seen == [session.OPEN_FILES] and spark.conf.get(name) == before
    assert rows(spark.read.schema(incremental.with_month_schema(RAW_OBSERVATION)).parquet(path)) == rows(df)
    assert spark.read.parquet(path).where(F.col(incremental.MONTH) == F.lit(dt.date(2001, 3, 1))).count() == 4


def test_sketch_query_gives_the_rows_of_the_anti_join(spark):
    assert rows(QUERIES["ingest_new_rows_by_sketch"](spark, SMOKE_DIR)) == rows(QUERIES["ingest_new_rows_anti_join"](spark, SMOKE_DIR))
