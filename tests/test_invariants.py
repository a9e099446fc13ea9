"""Invariants of the models on the sf0.001 tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldnotes.operators import panel
from fieldnotes.params import FIXTURE_PARAMS as P
from fieldnotes.plans.registry import models

from tests.support import SMOKE_DIR


def test_grid_size_is_periods_times_entities(spark):
    m = models(spark, SMOKE_DIR)
    start, end = panel.grid_bounds(panel.DAILY_SPECIES, P)
    days = (end - start).days + 1
    assert m.daily_species_panel.count() == days * m.species.count()
    mstart, mend = panel.grid_bounds(panel.MONTHLY_SPECIES, P)
    n_months = (mend.year - mstart.year) * 12 + mend.month - mstart.month + 1
    assert m.monthly_species_location_panel.count() == n_months * m.location_entities.count()


def test_cumulative_change_telescopes(spark):
    m = models(spark, SMOKE_DIR)
    for df in (m.monthly_species_panel, m.monthly_species_location_panel):
        assert df.where(F.col("cumulative_sum_mom_observations_change") != F.col("num_observations")).count() == 0
    daily = m.daily_species_panel
    first = F.first("num_observations").over(
        Window.partitionBy("taxon_id").orderBy("date_day_observed").rowsBetween(Window.unboundedPreceding, 0))
    check = daily.select(
        (F.col("cumulative_sum_dod_observations_change").isNull()
         | (F.col("cumulative_sum_dod_observations_change") == F.col("num_observations") - first)).alias("ok"))
    assert check.where(~F.col("ok")).count() == 0


def test_weekly_and_daily_totals_agree(spark):
    m = models(spark, SMOKE_DIR)
    daily = m.daily_species_panel.agg(F.sum("num_observations")).first()[0]
    weekly = m.weekly_species_summary.agg(F.sum("y")).first()[0]
    assert daily == weekly and daily > 0


def test_monthly_total_equals_distinct_facts(spark):
    m = models(spark, SMOKE_DIR)
    start, end = panel.grid_bounds(panel.MONTHLY_SPECIES, P)
    facts = m.species_facts.where(
        (F.col("date_day_observed") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("date_day_observed") < F.lit(P.as_of.replace(day=1)).cast("timestamp_ntz")))
    per_month = facts.groupBy("taxon_id", F.trunc(F.col("date_day_observed").cast("date"), "MM")).agg(
        F.count_distinct("inaturalist_id").alias("n")).agg(F.sum("n")).first()[0]
    panel_total = m.monthly_species_panel.where(
        F.col("date_month_observed") < F.lit(P.as_of.replace(day=1)).cast("timestamp_ntz")).agg(
        F.sum("num_observations")).first()[0]
    assert per_month == panel_total


def test_cluster_conf_follows_the_input():
    from fieldnotes.session import cluster_conf

    big = cluster_conf(100 * 10**12, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 10**12 // (256 << 20)
    small = cluster_conf(10**6, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16

