"""Landing audit, lenient reading, proven order, bitmap states and the membership sketch, on hand fixtures."""

import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldnotes.operators import distinct_state, incremental, membership, ordering, rejects, staging
from fieldnotes.params import Params
from fieldnotes.schemas import RAW_OBSERVATION
from fieldnotes.sources import landing_audit, testpages
from tests.support import raw_row, ts

P = Params(as_of=dt.date(2001, 10, 15), epoch=dt.date(1995, 1, 1))
PAGE = "place_id int, total_results long, per_page int, page int"


def test_missing_pages_in_the_middle_and_at_the_ends(spark):
    rows = [(1, 950, 100, n) for n in (2, 3, 6, 6, 7)]  # 10 pages: 1, 4-5 and 8-10 are missing
    rows += [(2, 250, 100, n) for n in (1, 2, 3)]  # whole
    rows += [(3, 200, 100, 1), (3, 201, 100, 2), (3, 310, 100, 9)]  # grew to 4 pages; page 9 is beyond them
    rows += [(4, None, 100, 1), (5, 10, 100, None), (None, 100, 50, 1)]
    got = landing_audit.missing_pages(spark.createDataFrame(rows, PAGE)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1, 1, 1), (1, 4, 5, 2), (1, 8, 10, 3), (3, 3, 4, 2), (None, 2, 3, 2)], key=str)
    assert landing_audit.missing_pages(spark.createDataFrame([], PAGE)).count() == 0


def test_lenient_staging_rejects_and_strict_staging_raises(spark, raw_df):
    raw = raw_df([raw_row(inaturalist_id=1), raw_row(inaturalist_id=2, location="45.5,west"), raw_row(inaturalist_id=3, place_ids="{1,b}"),
                  raw_row(inaturalist_id=4, location=None, place_ids=None), raw_row(inaturalist_id=5, location="x", place_ids="{y}"),
                  raw_row(inaturalist_id=6, location="45.5"), raw_row(inaturalist_id=7, place_ids="{}"),
                  raw_row(inaturalist_id=8, location="?", observed_date=ts("1990-01-01 00:00:00")), raw_row(inaturalist_id=9, place_ids="{1, 2}")])
    good, bad = rejects.stage_lenient(raw, P)
    assert sorted(r.inaturalist_id for r in good.collect()) == [1, 4, 6, 7, 9]
    assert {r.inaturalist_id: r.reason for r in bad.collect()} == {
        2: "location is not a list of numbers", 3: "place_ids is not a list of whole numbers", 5: "location is not a list of numbers"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_observations(raw, P).collect()


def test_corrupt_pages_are_rejected_whole(spark, raw_df):
    pages = testpages.pages_as_json(testpages.pages_from_observations(raw_df([raw_row(inaturalist_id=i) for i in range(3)]), 1))
    good = pages.collect()
    texts = [r.value for r in good] + [good[0].value[:-20], "", "[1, 2]", '{"total_results": "many", "results": []}', '{"results": []}', None]
    parsed, bad = rejects.split_pages(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sum(len(r.results) for r in parsed.collect()) == 3 and parsed.count() == len(good) + 1
    assert sorted(str(r.value) for r in bad.collect()) == sorted(str(t) for t in (*texts[len(good) : len(good) + 4], None))


def test_order_is_proven_and_a_swap_is_seen(spark):
    rng = np.random.default_rng(3)
    rows = [(None if x < 20 else int(x),) for x in rng.integers(0, 300, 500)]
    df = spark.createDataFrame(rows, "k int").repartition(7)
    in_order = df.repartitionByRange(5, F.col("k").asc_nulls_last()).sortWithinPartitions(F.col("k").asc_nulls_last())
    assert tuple(ordering.order_violations(df.orderBy(F.col("k").asc_nulls_last()), "k").first()) == (500, 0)
    assert tuple(ordering.order_violations(in_order, "k").first()) == (500, 0)
    assert ordering.order_violations(df, "k").first().num_violations > 0
    assert ordering.order_violations(df.orderBy(F.col("k").asc_nulls_first()), "k").first().num_violations > 0
    placed = in_order.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"), "k").collect()
    swap = {0: 1, 1: 0}
    swapped = spark.createDataFrame([(swap.get(r.part, r.part), r.pos, r.k) for r in placed], "part int, pos long, k int")
    assert ordering.violations(swapped).first().num_violations > 0
    gone = spark.createDataFrame([(2 * r.part, r.pos, r.k) for r in placed if r.part != 2], "part int, pos long, k int")  # an empty partition between
    assert ordering.violations(gone).first().num_violations == 0
    assert tuple(ordering.order_violations(df.where("false"), "k").first()) == (0, 0)


def test_merged_bitmaps_equal_a_recount(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), None if i % 50 == 0 else int(i)) for k, i in zip(rng.integers(0, 4, 4000), rng.integers(-40_000, 80_000, 4000))] + [(None, 7), (None, 7), (9, None)]
    df = spark.createDataFrame(rows, "k int, i long")
    parts = [df.where(F.pmod(F.xxhash64("i", "k"), F.lit(5)) <= 2), df.where(F.pmod(F.xxhash64("i", "k"), F.lit(5)) >= 2)]  # they share ids
    state = distinct_state.merged(*[distinct_state.state_of(p, ["k"], "i") for p in parts], ["k"])
    got = {r.k: r.n for r in distinct_state.counts(state, ["k"], "n").collect()}
    assert got == {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("i").alias("n")).collect()}
    assert got[9] == 0 and state.groupBy("k", "block").count().where("count > 1").count() == 0
    assert distinct_state.counts(distinct_state.state_of(df.where("false"), ["k"], "i"), ["k"], "n").count() == 0


@pytest.mark.parametrize("log_bits", [3, 20])  # a filter that lets nearly all pass, and one that lets nearly none
def test_sketch_gives_the_rows_of_the_anti_join(spark, raw_df, log_bits):
    stored = raw_df([raw_row(inaturalist_id=i, updated_at=ts(f"2001-0{1 + i % 3}-05 08:00:00")) for i in range(60)])
    batch = raw_df([raw_row(inaturalist_id=i, updated_at=ts(f"2001-0{1 + i % 3}-05 08:00:00")) for i in range(50, 90)] * 2)
    words = membership.sketch(stored, log_bits=log_bits).unionByName(membership.sketch(stored.limit(5), log_bits=log_bits))
    got = membership.new_rows(batch, stored, words, log_bits=log_bits)
    assert sorted(r.inaturalist_id for r in got.collect()) == list(range(60, 90)) and got.columns == batch.columns
    assert got.count() == incremental.new_rows(batch, stored).count()


def test_a_batch_of_unseen_ids_reads_no_log_file(spark, raw_df):
    path = os.path.join(tempfile.mkdtemp(prefix="sketch-"), "observations")
    incremental.load_increment(spark, raw_df([raw_row(inaturalist_id=i) for i in range(50)]), path, RAW_OBSERVATION)
    stored = spark.read.schema(incremental.with_month_schema(RAW_OBSERVATION)).parquet(path)
    words = spark.createDataFrame(membership.sketch(stored).collect(), "updated_month date, word long, bits long")
    fresh = membership.new_rows(raw_df([raw_row(inaturalist_id=i) for i in range(100, 120)]), stored, words)
    assert fresh.count() == 20 and not any("observations" in f for f in fresh.inputFiles())
    again = membership.new_rows(raw_df([raw_row(inaturalist_id=i) for i in range(49, 60)]), stored, words)
    assert again.count() == 10 and any("observations" in f for f in again.inputFiles())


def test_lenient_ingest_goes_on_and_strict_ingest_ends(spark, raw_df):
    from fieldnotes.plans import jobs

    base = tempfile.mkdtemp(prefix="lenient-")
    rows = [raw_row(inaturalist_id=1), raw_row(inaturalist_id=2, location="45.5,west"), raw_row(inaturalist_id=3)]
    testpages.land_pages(testpages.pages_from_observations(raw_df(rows), 1), f"{base}/landing")
    with open(f"{base}/landing/torn.txt", "w") as out:
        out.write('{"total_results": 3, "results": [{"id": 4')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.ingest(spark, f"{base}/landing", P, f"{base}/strict")
    assert jobs.ingest(spark, f"{base}/landing", P, f"{base}/wh", lenient=True) == 2
    assert jobs.ingest(spark, f"{base}/landing", P, f"{base}/wh", lenient=True) == 0
    assert sorted(r.inaturalist_id for r in jobs.stored_log(spark, f"{base}/wh").collect()) == [1, 3]
    bad = spark.read.parquet(f"{base}/wh/rejected_pages").collect()
    assert {(r.value[:20], r.reason) for r in bad} == {('{"total_results": 3,', "not a page")}
    assert {(r.inaturalist_id, r.reason) for r in spark.read.parquet(f"{base}/wh/rejected_observations").collect()} == {(2, "location is not a list of numbers")}
