"""Every registered query runs on the sf0.001 tables; every oracle-paired query
matches DuckDB on rows, columns and values."""

import pytest

import __spark_entry__ as E
from fieldnotes.plans.check import compare, duck

from tests.support import SMOKE_DIR

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["id", "date_month_observed"]


# the query keys of the SURVEY section 2 inventory
SURVEY_KEYS = """
ingest_explode ingest_flatten_json ingest_source_filter ingest_row_id ingest_high_water_mark upsert_by_key
ingest_new_rows_anti_join append_sink ingest_union_places stg_forecasts stg_observations numbers_spine
dates_spine months_spine species_dim species_to_locations species_to_locations_by_key daily_summary
monthly_summary daily_species_summary monthly_species_summary monthly_species_summary_by_location
weekly_species_summary forecast_prep_species forecast_prep_species_location day_of_week_summary
species_guess_correct lookback_filter forecast_trim_partial join_spine_left join_grid_left_2key
join_grid_left_3key grid_cross_join agg_count agg_count_distinct agg_conditional_distinct agg_sum_bool
agg_sum agg_by_expr win_lag_null win_lag_default win_rolling_avg win_rolling_max win_rolling_min
win_rolling_avg_change win_cumulative_sum win_partition_total sort_nulls_last fn_date_trunc_day
fn_parse_int_array fn_split_array fn_coordinates fn_array_get fn_round_decimal fn_surrogate_key
fn_date_trunc_month fn_null_safe_ratio fn_integer_delta fn_week_start_sunday fn_day_of_week fn_forecast_type
stream_ingest_available_now stream_dedupe forecast_grouped forecast_seasonal_naive forecast_stamped
forecast_all forecast_future_dates
""".split()

def test_survey_inventory_is_registered():
    assert set(ORACLES) <= set(QUERIES)
    assert set(SURVEY_KEYS) <= set(QUERIES)
    assert set(SURVEY_KEYS) <= set(ORACLES)  # every query of the inventory has its SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SMOKE_DIR), con, ORACLES[name])
    assert res["ok"], res
    assert con.sql(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0] > 0  # not nothing against nothing
