"""Small literal fixtures, one per semantic decision of the models."""

import datetime as dt

from pyspark.sql import functions as F

from fieldnotes.operators import dims, panel, rollups, spines, staging
from fieldnotes.params import Params

from tests.support import raw_row, ts

P = Params(as_of=dt.date(2001, 10, 15), epoch=dt.date(1995, 1, 1), lookback_years=1, dow_since=dt.date(2000, 1, 1))


def test_staging_guess_flags_and_epoch_bound(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, species_guess=None),
        raw_row(inaturalist_id=2, species_guess="Rough-skinned Newt"),
        raw_row(inaturalist_id=3, species_guess="rough-skinned newt"),
        raw_row(inaturalist_id=4, observed_date=ts("1994-12-31 23:00:00")),
        raw_row(inaturalist_id=5, observed_date=ts("1995-01-01 00:00:00")),
        raw_row(inaturalist_id=6, observed_date=None),
    ])
    out = {r.inaturalist_id: r for r in staging.stage_observations(raw, P).collect()}
    assert set(out) == {1, 2, 3, 5}
    assert (out[1].species_guess_correct, out[2].species_guess_correct, out[3].species_guess_correct) == (None, True, False)
    assert out[5].date_day_observed == dt.datetime(1995, 1, 1)


def test_staging_coordinates_cells_and_partial_locations(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, location="45.504,-122.5"),
        raw_row(inaturalist_id=2, location="45.496,-122.5"),
        raw_row(inaturalist_id=3, location="45.5"),
        raw_row(inaturalist_id=4, location=None),
    ])
    out = {r.inaturalist_id: r for r in staging.stage_observations(raw, P).collect()}
    assert out[1].location_id == out[2].location_id
    assert str(out[3].latitude) == "45.500000" and out[3].longitude is None
    assert out[4].coordinates is None and out[4].latitude is None
    assert out[3].location_id != out[1].location_id  # a missing longitude is its own cell


def test_species_dimension_keeps_renamed_taxon_and_drops_genus(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, taxon_id=10, name="Old name"),
        raw_row(inaturalist_id=2, taxon_id=10, name="New name"),
        raw_row(inaturalist_id=3, taxon_id=11, name="A genus", rank="genus"),
    ])
    staged = staging.stage_observations(raw, P)
    sp = dims.species(staged, P).collect()
    assert sorted((r.taxon_id, r.latin_name) for r in sp) == [(10, "New name"), (10, "Old name")]
    locs = dims.species_to_locations_by_key(staged).collect()
    assert {r.taxon_id for r in locs} == {10, 11}  # no rank filter in the location dimension


def test_species_to_locations_dates_are_per_observation_row(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, observed_date=ts("2001-01-01 00:00:00")),
        raw_row(inaturalist_id=2, observed_date=ts("2001-02-01 00:00:00")),
    ])
    staged = staging.stage_observations(raw, P)
    faithful = dims.species_to_locations(staged).collect()
    by_key = dims.species_to_locations_by_key(staged).collect()
    assert len(faithful) == 2 and len(by_key) == 1
    assert by_key[0].first_observation_date == dt.datetime(2001, 1, 1)
    assert by_key[0].most_recent_observation_date == dt.datetime(2001, 2, 1)


def test_daily_summary_gap_days_are_null_and_sorted_last(spark, raw_df):
    p = Params(as_of=dt.date(2001, 1, 5), epoch=dt.date(2001, 1, 1), horizon_days=0)
    raw = raw_df([
        raw_row(inaturalist_id=1, observed_date=ts("2001-01-01 00:00:00"), endemic=True),
        raw_row(inaturalist_id=2, observed_date=ts("2001-01-03 00:00:00"), taxon_id=11),
    ])
    staged = staging.stage_observations(raw, p)
    out = rollups.daily_summary(staged, spines.dates_spine(spark, p), p).collect()
    assert [r.date_day for r in out][:2] == [dt.date(2001, 1, 1), dt.date(2001, 1, 3)]
    gaps = [r for r in out if r.date_day_observed is None]
    assert len(out) == 5 and len(gaps) == 3
    assert all(r.num_observations is None and r.pct_taxon_endemic is None for r in gaps)
    first = out[0]
    assert (first.num_observations, first.num_taxon_observed, first.num_endemic_taxon_observed) == (1, 1, 1)
    assert first.pct_taxon_endemic == 1.0


def test_conditional_distinct_counts_match_a_direct_count(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, taxon_id=10, endemic=True),
        raw_row(inaturalist_id=2, taxon_id=10, endemic=False),
        raw_row(inaturalist_id=3, taxon_id=11, endemic=None, threatened=True),
        raw_row(inaturalist_id=4, taxon_id=None, endemic=True),
    ])
    staged = staging.stage_observations(raw, P)
    r = rollups.period_aggregates(staged, F.col("date_day_observed"), "d").first()
    assert r.num_observations == 4
    assert r.num_taxon_observed == 2  # NULL taxon is not a distinct value
    assert r.num_endemic_taxon_observed == 1
    assert r.num_endemic_observations == 2
    assert r.num_threatened_taxon_observed == 1


def test_day_of_week_summary_labels_and_order(spark, raw_df):
    raw = raw_df([
        raw_row(inaturalist_id=1, observed_date=ts("2001-10-13 00:00:00")),
        raw_row(inaturalist_id=2, observed_date=ts("2001-10-14 00:00:00")),
        raw_row(inaturalist_id=3, observed_date=ts("2001-10-14 00:00:00")),
        raw_row(inaturalist_id=4, observed_date=ts("1999-10-14 00:00:00")),
    ])
    out = rollups.day_of_week_summary(staging.stage_observations(raw, P), P).collect()
    assert [(r._day_of_week, r.num_observations) for r in out] == [("Sunday", 2), ("Saturday", 1)]


def _monthly_panel(spark, raw, p):
    staged = staging.stage_observations(raw, p)
    return panel.panel(staging.species_level(staged, p), dims.species(staged, p), panel.MONTHLY_SPECIES, p)


def test_monthly_changes_deltas_and_cumulative_sum(spark, raw_df):
    p = Params(as_of=dt.date(2001, 5, 15), epoch=dt.date(2001, 1, 1), lookback_years=0)
    # Jan 0 (prior default 0), Feb 3, Mar 2, Apr 2, May 5
    counts = {2: 3, 3: 2, 4: 2, 5: 5}
    rows, iid = [], 0
    for month, n in counts.items():
        for _ in range(n):
            iid += 1
            rows.append(raw_row(inaturalist_id=iid, observed_date=ts(f"2001-{month:02d}-02 00:00:00")))
    out = _monthly_panel(spark, raw_df(rows), p).orderBy("date_month_observed").collect()
    assert [r.num_observations for r in out] == [0, 3, 2, 2, 5]
    assert [r.prior_month_observations for r in out] == [0, 0, 3, 2, 2]
    assert [r.mom_observations_change for r in out] == [0, 3, -1, 0, 3]
    assert [r.mom_observations_delta for r in out] == [None, None, 0, 0, 1]
    # cumulative change telescopes to n(t) when the first prior is 0
    assert [r.cumulative_sum_mom_observations_change for r in out] == [0, 3, 2, 2, 5]
    assert [r.max_local_three_month_observations for r in out] == [0, 3, 3, 3, 5]
    assert out[2].avg_rolling_three_month_observations == 5 / 3


def test_monthly_year_lag_is_twelve_rows_and_grid_is_dense(spark, raw_df):
    p = Params(as_of=dt.date(2001, 3, 15), epoch=dt.date(2000, 1, 1), lookback_years=1)
    raw = raw_df([
        raw_row(inaturalist_id=1, observed_date=ts("2000-02-10 00:00:00")),
        raw_row(inaturalist_id=2, observed_date=ts("2001-02-11 00:00:00"), taxon_id=11, name="B"),
    ])
    out = _monthly_panel(spark, raw, p).collect()
    assert len(out) == 15 * 2  # 15 months (Jan 2000 .. Mar 2001) x 2 taxa
    feb01 = [r for r in out if r.taxon_id == 10 and r.date_month_observed == dt.datetime(2001, 2, 1)][0]
    assert feb01.one_year_ago_observations == 1 and feb01.yoy_observations_change == -1


def test_daily_panel_prior_is_null_first_and_distinct_ids(spark, raw_df):
    p = Params(as_of=dt.date(2001, 1, 4), epoch=dt.date(2001, 1, 1), lookback_years=0)
    raw = raw_df([
        raw_row(inaturalist_id=1, observed_date=ts("2001-01-02 00:00:00"), species_guess="Rough-skinned Newt"),
        raw_row(inaturalist_id=1, observed_date=ts("2001-01-02 00:00:00"), updated_at=ts("2001-02-01 00:00:00"),
                species_guess="Rough-skinned Newt"),
    ])
    staged = staging.stage_observations(raw, p)
    out = panel.panel(staging.species_level(staged, p), dims.species(staged, p), panel.DAILY_SPECIES, p)
    rows = out.orderBy("date_day_observed").collect()
    assert [r.num_observations for r in rows] == [0, 1, 0]  # two versions, one observation
    assert [r.num_correct_guesses for r in rows] == [0, 2, 0]  # every version counts
    assert rows[0].prior_day_observations is None and rows[0].dod_observations_change is None
    # daily cumulative change telescopes to n(t) - n(first)
    assert [r.cumulative_sum_dod_observations_change for r in rows] == [None, 1, 0]


def test_weekly_sums_match_daily_sums(spark, raw_df):
    p = Params(as_of=dt.date(2001, 3, 1), epoch=dt.date(2001, 1, 1), lookback_years=0)
    raw = raw_df([raw_row(inaturalist_id=i, observed_date=ts(f"2001-01-{i:02d} 00:00:00")) for i in range(1, 29)])
    staged = staging.stage_observations(raw, p)
    daily = panel.panel(staging.species_level(staged, p), dims.species(staged, p), panel.DAILY_SPECIES, p)
    weekly = rollups.weekly_species_summary(daily)
    assert weekly.agg(F.sum("y")).first()[0] == daily.agg(F.sum("num_observations")).first()[0] == 28
    first = weekly.orderBy("ds").first()
    assert first.ds == dt.datetime(2000, 12, 31)  # the Sunday before Jan 1st, 2001 (a Monday)
    assert first.one_year_ago_y is None and first.yoy_delta is None


def test_daily_year_lag_is_365_rows_across_a_leap_year(spark, raw_df):
    # 2000 is a leap year: 365 rows back from 2001-01-01 is 2000-01-02, not 2000-01-01
    p = Params(as_of=dt.date(2001, 1, 3), epoch=dt.date(2000, 1, 1), lookback_years=1)
    raw = raw_df([raw_row(inaturalist_id=1, observed_date=ts("2000-01-02 00:00:00")),
                  raw_row(inaturalist_id=2, observed_date=ts("2000-01-01 00:00:00"))])
    staged = staging.stage_observations(raw, p)
    out = {r.date_day_observed: r for r in panel.panel(
        staging.species_level(staged, p), dims.species(staged, p), panel.DAILY_SPECIES, p).collect()}
    assert len(out) == 368  # 366 days of 2000 + Jan 1st and 2nd 2001
    assert out[dt.date(2001, 1, 1)].one_year_ago_observations == 1  # the 2000-01-02 observation
    assert out[dt.date(2000, 12, 31)].one_year_ago_observations == 1  # 365 rows back is 2000-01-01


def test_renamed_taxon_gets_the_same_counts_under_each_name(spark, raw_df):
    p = Params(as_of=dt.date(2001, 3, 15), epoch=dt.date(2001, 1, 1), lookback_years=0)
    raw = raw_df([
        raw_row(inaturalist_id=1, name="Old name", observed_date=ts("2001-01-05 00:00:00")),
        raw_row(inaturalist_id=2, name="New name", observed_date=ts("2001-02-05 00:00:00")),
        raw_row(inaturalist_id=3, name="New name", observed_date=ts("2001-02-06 00:00:00")),
    ])
    out = _monthly_panel(spark, raw, p).collect()
    by_name = {}
    for r in out:
        by_name.setdefault(r.latin_name, []).append((r.date_month_observed.month, r.num_observations))
    assert sorted(by_name["Old name"]) == sorted(by_name["New name"]) == [(1, 1), (2, 2), (3, 0)]


def test_forecast_threshold_is_strictly_greater(spark, raw_df):
    from fieldnotes.operators import forecast

    p = Params(as_of=dt.date(2001, 3, 15), epoch=dt.date(2001, 1, 1), lookback_years=0, prep_lookback_years=0)
    rows, iid = [], 0
    for taxon, total in ((10, 10), (11, 11)):
        for _ in range(total):
            iid += 1
            rows.append(raw_row(inaturalist_id=iid, taxon_id=taxon, name=f"T{taxon}",
                                observed_date=ts("2001-02-03 00:00:00")))
    prepped = forecast.prep(_monthly_panel(spark, raw_df(rows), p), "taxon_id", 10, p)
    assert {r.unique_id for r in prepped.collect()} == {11}


def test_genus_location_appears_in_the_location_panel_with_zeros(spark, raw_df):
    p = Params(as_of=dt.date(2001, 3, 15), epoch=dt.date(2001, 1, 1), lookback_years=0)
    raw = raw_df([
        raw_row(inaturalist_id=1, taxon_id=10, observed_date=ts("2001-02-03 00:00:00")),
        raw_row(inaturalist_id=2, taxon_id=20, name="A genus", rank="genus", location="46.0,-123.0",
                observed_date=ts("2001-02-03 00:00:00")),
    ])
    staged = staging.stage_observations(raw, p)
    entities = dims.species_to_locations_by_key(staged).withColumnRenamed("id", "species_location_id")
    out = panel.panel(staging.species_level(staged, p), entities, panel.MONTHLY_SPECIES_LOCATION, p).collect()
    genus = [r for r in out if r.taxon_id == 20]
    assert len(genus) == 3 and all(r.num_observations == 0 for r in genus)
    assert sum(r.num_observations for r in out if r.taxon_id == 10) == 1
