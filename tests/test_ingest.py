import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from fieldnotes.operators import incremental
from fieldnotes.schemas import RAW_OBSERVATION
from fieldnotes.sources import api_pages, testpages
from fieldnotes.streaming import ingest as streaming

from tests.support import raw_row, ts

AS_OF = dt.date(2001, 10, 15)


def _write_pages(folder, pages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"page-{len(os.listdir(folder))}.json"), "w") as fh:
        for p in pages:
            fh.write(json.dumps(p) + "\n")


def _result(i, details="present", taxon=True, updated="2001-05-01T10:00:00+00:00"):
    r = {"id": i, "species_guess": "Rough-skinned Newt", "location": "45.5,-122.5", "place_ids": [1, 2],
         "updated_at": updated}
    if details == "present":
        r["observed_on_details"] = {"date": "2001-04-30", "month": 4, "hour": 9, "week": 18, "year": 2001, "day": 30}
    elif details == "null":
        r["observed_on_details"] = None
    if taxon:
        r["taxon"] = {"id": 10, "name": "Taricha granulosa", "rank": "species",
                      "preferred_common_name": "Rough-skinned Newt", "native": True}
    return r


def test_flatten_is_null_safe_for_missing_or_null_details(spark):
    folder = tempfile.mkdtemp(prefix="pages-")
    _write_pages(folder, [{"total_results": 3, "per_page": 100, "place_id": 1,
                           "results": [_result(1), _result(2, details="missing"), _result(3, details="null", taxon=False)]}])
    pages = api_pages.read_pages(spark, folder)
    rows = {r.inaturalist_id: r for r in api_pages.flatten_results(api_pages.explode_results(pages), AS_OF).collect()}
    assert rows[1].observed_date == dt.datetime(2001, 4, 30) and rows[1].observed_month == 4.0
    assert rows[2].observed_date is None and rows[2].observed_month is None
    assert rows[3].observed_date is None and rows[3].taxon_id is None and rows[3].name is None
    assert rows[1].updated_at == dt.datetime(2001, 5, 1, 10, 0)
    assert rows[1].place_ids == "{1,2}"
    assert rows[1].id == "1988711200.0Tarosa"
    assert rows[3].id.endswith("Nonone")


def test_pages_round_trip_and_page_size(spark, raw_df):
    raw = raw_df([raw_row(inaturalist_id=i) for i in range(1, 251)])
    pages = testpages.pages_from_observations(raw, place_id=1, per_page=100)
    sizes = [r.n for r in pages.select(F.size("results").alias("n")).collect()]
    assert sum(sizes) == 250 and max(sizes) <= 100
    back = api_pages.flatten_results(api_pages.explode_results(
        api_pages.parse_pages(testpages.pages_as_json(pages))), dt.date(2001, 10, 15))
    assert sorted(back.select("id").toPandas()["id"]) == sorted(raw.select("id").toPandas()["id"])
    assert testpages.pages_from_observations(raw, place_id=99).count() == 0


def test_high_water_mark_empty_and_filled(spark, raw_df):
    empty = spark.createDataFrame([], RAW_OBSERVATION)
    assert incremental.high_water_mark(empty).first().high_water_mark is None
    raw = raw_df([raw_row(inaturalist_id=1, updated_at=ts("2001-05-03 22:10:00")),
                  raw_row(inaturalist_id=2, updated_at=ts("2001-05-01 08:00:00"))])
    hwm = incremental.high_water_mark(raw)
    assert hwm.first().high_water_mark == "2001-05-03"
    # rows updated on the high-water-mark day are pulled again (and dropped by the anti-join)
    assert incremental.updated_since(raw, hwm).count() == 1
    assert incremental.updated_since(raw, incremental.high_water_mark(empty)).count() == 2


def test_new_rows_anti_join_and_batch_dedupe(spark, raw_df):
    stored = raw_df([raw_row(inaturalist_id=1)])
    batch = raw_df([raw_row(inaturalist_id=1), raw_row(inaturalist_id=2), raw_row(inaturalist_id=2)])
    fresh = incremental.new_rows(batch, stored)
    assert [r.inaturalist_id for r in fresh.collect()] == [2]


def test_dedupe_by_key_is_deterministic(spark, raw_df):
    a = raw_row(inaturalist_id=1, species_guess="b")
    b = raw_row(inaturalist_id=1, species_guess="a")
    df = raw_df([a, b])
    assert incremental.dedupe_by_key(df).first().species_guess == "a"
    assert incremental.dedupe_by_key(raw_df([b, a])).first().species_guess == "a"


def test_upsert_replaces_by_key_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = incremental.upsert(target, updates, ["k"])
    twice = incremental.upsert(once, updates, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_load_increment_first_run_and_replay(spark, raw_df):
    path = os.path.join(tempfile.mkdtemp(prefix="log-"), "observations")
    batch = raw_df([raw_row(inaturalist_id=i) for i in range(5)])
    assert incremental.load_increment(spark, batch, path, RAW_OBSERVATION) == 5
    assert incremental.load_increment(spark, batch, path, RAW_OBSERVATION) == 0
    assert spark.read.parquet(path).count() == 5


def test_available_now_stream_merges_without_duplicates(spark, raw_df):
    base = tempfile.mkdtemp(prefix="stream-")
    landing, target = os.path.join(base, "landing"), os.path.join(base, "log")
    raw = raw_df([raw_row(inaturalist_id=i) for i in range(1, 31)])
    testpages.land_pages(testpages.pages_from_observations(raw.where("inaturalist_id <= 20"), 1), landing)
    testpages.land_pages(testpages.pages_from_observations(raw.where("inaturalist_id > 10"), 1), landing)
    streaming.ingest_available_now(spark, landing, target, os.path.join(base, "ckpt"), AS_OF, max_files_per_trigger=1)
    assert streaming.read_log(spark, target).count() == 30
    # a second run sees no new files and appends nothing
    streaming.ingest_available_now(spark, landing, target, os.path.join(base, "ckpt"), AS_OF)
    assert streaming.read_log(spark, target).count() == 30


def test_dedupe_stream_keeps_every_id_whatever_its_age(spark, raw_df):
    """Eight files with mixed dates, each id in several copies that differ: every id stays, with its smallest copy,
    and the batch size changes nothing."""
    base = tempfile.mkdtemp(prefix="dedupe-")
    landing = os.path.join(base, "landing")
    stamp = [ts(f"{y}-05-01 08:00:00") for y in (2001, 1996, 1999, 2000, 1995, 1998, 2001, 1997)]
    for f in range(8):
        rows = [raw_row(inaturalist_id=i, updated_at=stamp[i % 8], species_guess="cab"[(f + i) % 3]) for i in range(f, f + 24)]
        testpages.land_pages(testpages.pages_from_observations(raw_df(rows).coalesce(1), 1), landing)
    got = []
    for n, size in enumerate((1, 3, None)):
        out = streaming.dedupe_stream(spark, landing, os.path.join(base, f"out{n}"), os.path.join(base, f"ckpt{n}"), AS_OF, size)
        got.append(sorted((r.inaturalist_id, r.species_guess, r.id) for r in out.collect()))
    assert got[0] == got[1] == got[2] and [g[0] for g in got[0]] == list(range(31))
    files = {i: {"cab"[(f + i) % 3] for f in range(8) if f <= i < f + 24} for i in range(31)}
    assert all(guess == min(files[i]) for i, guess, _ in got[0])


def test_state_of_the_stream_is_bounded_and_loses_nothing(spark, raw_df):
    """Twelve files, each a new id in and an old one out, observed in ever earlier years: with a short memory the state
    holds a few batches, with a long one everything; the log is the same, forgotten copies are settled by the anti-join."""
    base = tempfile.mkdtemp(prefix="state-")
    landing = os.path.join(base, "landing")
    for f in range(12):
        rows = [raw_row(inaturalist_id=i, updated_at=ts(f"{2001 - i // 4}-05-01 08:00:00")) for i in range(f, f + 6)]
        testpages.land_pages(testpages.pages_from_observations(raw_df(rows).coalesce(1), 1), landing)
    testpages.land_pages(testpages.pages_from_observations(raw_df([raw_row(inaturalist_id=0, updated_at=ts("2001-05-01 08:00:00"))]), 1), landing)
    got, state, logged = [], [], []
    for n, remember in enumerate(("0 seconds", "1 hour")):
        target = os.path.join(base, f"log{n}")
        progress = streaming.ingest_available_now(spark, landing, target, os.path.join(base, f"ckpt{n}"), AS_OF, 1, remember)
        state.append([p["stateOperators"][0]["numRowsTotal"] for p in progress])
        assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 0
        got.append(sorted(r.inaturalist_id for r in streaming.read_log(spark, target).collect()))
        logged.append(spark.read.parquet(target).count())
    assert got[0] == got[1] == list(range(17)) and logged == [17, 17]
    assert max(state[0]) <= 12 and max(state[1]) == 17


def test_captive_results_are_left_out(spark):
    folder = tempfile.mkdtemp(prefix="pages-")
    _write_pages(folder, [{"place_id": 1, "results": [_result(1) | {"captive": True}, _result(2) | {"captive": False},
                                                       _result(3), _result(4, details="missing", taxon=False) | {"captive": None}]}])
    results = api_pages.wild(api_pages.explode_results(api_pages.read_pages(spark, folder)))
    assert sorted(r.inaturalist_id for r in api_pages.flatten_results(results, AS_OF).collect()) == [2, 3, 4]


def test_job_asks_for_taxa_and_places(spark, raw_df):
    from fieldnotes.params import Params
    from fieldnotes.plans import jobs

    base = tempfile.mkdtemp(prefix="ask-")
    raw = raw_df([raw_row(inaturalist_id=1, taxon_id=10), raw_row(inaturalist_id=2, taxon_id=20), raw_row(inaturalist_id=3, taxon_id=10, place_ids="{9}")])
    for place in (1, 9):
        testpages.land_pages(testpages.pages_from_observations(raw, place), f"{base}/landing")
    assert jobs.ingest(spark, f"{base}/landing", Params(as_of=AS_OF, taxon_ids=(10,)), f"{base}/wh") == 1
    assert jobs.ingest(spark, f"{base}/landing", Params(as_of=AS_OF, places=()), f"{base}/wh2") == 3


def test_new_rows_join_on_the_month_too(spark, raw_df):
    path = os.path.join(tempfile.mkdtemp(prefix="days-"), "observations")
    old = raw_df([raw_row(inaturalist_id=i, updated_at=ts(f"2001-05-0{1 + i % 5} 08:00:00")) for i in range(10)])
    incremental.load_increment(spark, old, path, RAW_OBSERVATION)
    stored = spark.read.schema(incremental.with_month_schema(RAW_OBSERVATION)).parquet(path)
    batch = raw_df([raw_row(inaturalist_id=1, updated_at=ts("2001-05-02 08:00:00")), raw_row(inaturalist_id=99)])
    fresh = incremental.new_rows(batch, stored)
    assert [r.inaturalist_id for r in fresh.collect()] == [99]
    assert os.path.isdir(f"{path}/updated_month=2001-05-01")
    assert incremental.high_water_mark(stored).first().high_water_mark == "2001-05-05"


def test_pull_reads_only_landings_since_the_high_water_mark(spark, raw_df):
    from fieldnotes.plans import jobs
    from fieldnotes.params import Params

    base = tempfile.mkdtemp(prefix="pull-")
    landing, warehouse = os.path.join(base, "landing"), os.path.join(base, "wh")
    old = raw_df([raw_row(inaturalist_id=i, updated_at=ts("2001-05-01 08:00:00")) for i in range(1, 6)])
    new = raw_df([raw_row(inaturalist_id=i, updated_at=ts("2001-06-02 09:00:00")) for i in range(4, 9)])
    testpages.land_pages(testpages.pages_from_observations(old, 1), landing, load_date=dt.date(2001, 5, 1))
    p = Params(as_of=dt.date(2001, 6, 3), epoch=dt.date(1995, 1, 1))
    assert jobs.ingest(spark, landing, p, warehouse) == 5
    testpages.land_pages(testpages.pages_from_observations(new, 1), landing, load_date=dt.date(2001, 6, 2))
    pruned = api_pages.read_pages(spark, landing, since=dt.date(2001, 5, 2))
    assert "PartitionFilters: [isnotnull(load_date" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.select(F.explode("results")).count() == 5
    assert jobs.ingest(spark, landing, p, warehouse) == 5  # versions 4..8 are new rows (new updated_at)
    assert jobs.ingest(spark, landing, p, warehouse) == 0
