"""Dense period x entity panels with lag, rolling, YoY and cumulative metrics.

One parameterised job serves the daily species panel, the monthly species
panel and the monthly species x location panel.

Plan shape (no Cartesian join; one partitioning by entity for everything
after the fact aggregation):

1. facts are cut to the grid's date range and aggregated per
   (entity keys, period): ``COUNT(DISTINCT inaturalist_id)`` and the sum of
   correct guesses. Spark plans the distinct count as partial aggregates keyed
   by (keys, period, id), so a hot taxon is spread over periods and ids.
2. the grid is generated per entity with ``explode(sequence(start, end))``,
   a narrow operator; its length is fixed by the parameters.
3. the counts (hash-partitioned by the entity key) are matched to the entity
   rows on that key, unioned with the grid rows and summed per cell; union,
   sum and every window reuse the one entity partitioning under default
   settings. Rows per entity are bounded by the grid length.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.functions import integer_delta, month_key, surrogate_key
from fieldnotes.params import Params


@dataclass(frozen=True)
class PanelSpec:
    name: str                       # the model, for its own lookback
    grain: str                      # "day" or "month"
    date_col: str                   # output name of the period column
    partition_key: str              # window partition (entity id)
    join_keys: tuple[str, ...]      # entity columns matched against facts
    carry: tuple[str, ...]          # entity columns kept in the output, in order
    prior_default: int | None       # LAG(n, 1, default)
    year_lag: int                   # rows back for "one year ago"
    window: int                     # rolling frame length in rows
    period_word: str                # "day" / "month" in column names
    frame_word: str                 # "seven_day" / "three_month"
    change_word: str                # "dod" / "mom"
    id_keys: tuple[str, ...] | None = None  # surrogate id of the output row
    tie_break: tuple[str, ...] = ("latin_name", "preferred_common_name")
    # when set, the entity key is the surrogate key of these fact columns and
    # is computed after aggregation (once per cell, not once per fact row)
    key_from: tuple[str, ...] | None = None


DAILY_SPECIES = PanelSpec(
    name="daily_species_summary", grain="day", date_col="date_day_observed", partition_key="taxon_id",
    join_keys=("taxon_id",), carry=("taxon_id", "latin_name", "preferred_common_name"),
    prior_default=None, year_lag=365, window=7, period_word="day",
    frame_word="seven_day", change_word="dod",
)

MONTHLY_SPECIES = PanelSpec(
    name="monthly_species_summary", grain="month", date_col="date_month_observed", partition_key="taxon_id",
    join_keys=("taxon_id",), carry=("taxon_id", "latin_name", "preferred_common_name"),
    prior_default=0, year_lag=12, window=3, period_word="month",
    frame_word="three_month", change_word="mom", id_keys=("taxon_id", "date_month_observed"),
)

MONTHLY_SPECIES_LOCATION = PanelSpec(
    name="monthly_species_summary_by_location", grain="month", date_col="date_month_observed", partition_key="species_location_id",
    join_keys=("species_location_id", "taxon_id", "location_id"),
    carry=("species_location_id", "taxon_id", "latin_name", "preferred_common_name"),
    prior_default=0, year_lag=12, window=3, period_word="month",
    frame_word="three_month", change_word="mom",
    id_keys=("species_location_id", "date_month_observed"),
    key_from=("taxon_id", "location_id"),
)


def grid_bounds(spec: PanelSpec, params: Params) -> tuple[dt.date, dt.date]:
    """First and last period of the grid.

    Start: the later of the spine start and January 1st of the lookback year.
    End: the last period strictly before ``as_of``. Every frame in the panel
    looks backwards only, so cutting the spine before the windows gives the
    same rows as filtering after them.
    """
    last_day = params.as_of - dt.timedelta(days=1)
    if spec.grain == "day":
        return max(params.epoch, params.lookback_start(spec.name)), last_day
    return max(params.epoch.replace(day=1), params.lookback_start(spec.name)), last_day.replace(day=1)


def _period(spec: PanelSpec, col: str) -> F.Column:
    return F.col(col).cast("date") if spec.grain == "day" else month_key(col)


def fact_counts(facts: DataFrame, spec: PanelSpec, params: Params) -> DataFrame:
    """Distinct observations and correct guesses per (entity, period) of the grid."""
    start, end = grid_bounds(spec, params)
    upper = end + dt.timedelta(days=1) if spec.grain == "day" else _month_after(end)
    cut = facts.where(
        (F.col("date_day_observed") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("date_day_observed") < F.lit(upper).cast("timestamp_ntz"))
    )
    keys = [k for k in spec.join_keys if k != spec.partition_key] if spec.key_from else list(spec.join_keys)
    counts = cut.groupBy(*keys, _period(spec, "date_day_observed").alias(spec.date_col)).agg(
        F.count_distinct("inaturalist_id").alias("_n"),
        F.sum(F.col("species_guess_correct").cast("int")).alias("_correct"),
    )
    if spec.key_from:
        counts = counts.withColumn(spec.partition_key, surrogate_key(*spec.key_from))
    return counts


def _month_after(d: dt.date) -> dt.date:
    return d.replace(year=d.year + d.month // 12, month=d.month % 12 + 1, day=1)


def grid_counts(facts: DataFrame, entities: DataFrame, spec: PanelSpec, params: Params) -> DataFrame:
    """Grid LEFT JOIN fact counts on (entity keys, period); empty cells count 0.

    Written as a union so that every step keeps one hash partitioning by the
    entity key, under Spark's default settings:

    * counts are joined to the entity rows on the entity key alone (both
      sides hash-partitioned by it; the other join keys are then compared, so
      the match is exactly the multi-key join, including one row per name of
      a renamed taxon);
    * the grid rows (count 0) and the matched count rows are unioned, which
      keeps the shared partitioning, and summed per (entity, period).

    The sum equals the left join: each grid cell has one grid row and at most
    one count row per entity row, and counts exist only inside the grid range.
    """
    keep = list(dict.fromkeys(spec.carry + spec.join_keys))
    ents = entities.select(*keep).repartition(spec.partition_key)
    start, end = grid_bounds(spec, params)
    step = F.expr("interval 1 day") if spec.grain == "day" else F.expr("interval 1 month")
    seq = F.sequence(F.lit(start), F.lit(end), step)
    if spec.grain == "month":
        seq = F.transform(seq, lambda x: x.cast("timestamp_ntz"))
    zero = F.lit(0).cast("long")
    grid = ents.select(*spec.carry, F.explode(seq).alias(spec.date_col), zero.alias("_n"), zero.alias("_correct"))

    counts = fact_counts(facts, spec, params).repartition(spec.partition_key)
    c = counts.alias("c")
    e = ents.alias("e")
    pk = spec.partition_key
    # Only the entity key is an equi-join key. The other keys are compared in
    # the join condition with array_contains(array(a), b): exact equality that
    # rejects NULL like the inner join, but not an equality the planner turns
    # into another join key. So the join needs no partitioning beyond the
    # entity key.
    cond = [F.col(f"c.{pk}") == F.col(f"e.{pk}")] + [
        F.array_contains(F.array(F.col(f"c.{k}")), F.col(f"e.{k}")) for k in spec.join_keys if k != pk
    ]
    matched = c.join(e, cond, "inner").select(
        *[F.col(f"e.{k}").alias(k) for k in spec.carry],
        F.col(f"c.{spec.date_col}").alias(spec.date_col),
        F.col("c._n").alias("_n"),
        F.coalesce(F.col("c._correct"), zero).alias("_correct"),
    )
    return grid.unionByName(matched).groupBy(spec.date_col, *spec.carry).agg(
        F.sum("_n").cast("int").alias("num_observations"),
        F.sum("_correct").cast("int").alias("num_correct_guesses"),
    ).select(spec.date_col, *spec.carry, "num_observations", "num_correct_guesses")


def names(spec: PanelSpec) -> dict[str, str]:
    p, fr, ch = spec.period_word, spec.frame_word, spec.change_word
    return {
        "prior": f"prior_{p}_observations",
        "year": "one_year_ago_observations",
        "change": f"{ch}_observations_change",
        "delta": f"{ch}_observations_delta",
        "yoy_change": "yoy_observations_change",
        "yoy_delta": "yoy_observations_delta",
        "avg": f"avg_rolling_{fr}_observations",
        "max": f"max_local_{fr}_observations",
        "min": f"min_local_{fr}_observations",
        "avg_change": f"avg_rolling_{fr}_{ch}_observations_change",
        "cumsum": f"cumulative_sum_{ch}_observations_change",
    }


def window_metrics(counts: DataFrame, spec: PanelSpec) -> DataFrame:
    """All window columns. Every window shares one partitioning and one sort."""
    nm = names(spec)
    ordered = Window.partitionBy(spec.partition_key).orderBy(spec.date_col, *spec.tie_break)
    frame = ordered.rowsBetween(-(spec.window - 1), Window.currentRow)
    # default frame: RANGE from the partition start to the current period
    running = Window.partitionBy(spec.partition_key).orderBy(spec.date_col)
    n = F.col("num_observations")
    prior = (F.lag(n, 1).over(ordered) if spec.prior_default is None
             else F.lag(n, 1, spec.prior_default).over(ordered))
    step1 = counts.select(
        "*",
        prior.alias(nm["prior"]),
        F.lag(n, spec.year_lag, 0).over(ordered).alias(nm["year"]),
        F.avg(n).over(frame).alias(nm["avg"]),
        F.max(n).over(frame).alias(nm["max"]),
        F.min(n).over(frame).alias(nm["min"]),
    )
    change = n - F.col(nm["prior"])
    yoy = n - F.col(nm["year"])
    step2 = step1.select(
        "*",
        change.alias(nm["change"]),
        integer_delta(change, nm["prior"]).alias(nm["delta"]),
        yoy.alias(nm["yoy_change"]),
        integer_delta(yoy, nm["year"]).alias(nm["yoy_delta"]),
    )
    step3 = step2.select(
        "*",
        F.avg(nm["change"]).over(frame).alias(nm["avg_change"]),
        F.sum(nm["change"]).over(running).alias(nm["cumsum"]),
    )
    cols = [
        spec.date_col, *spec.carry, "num_observations", "num_correct_guesses",
        nm["prior"], nm["year"], nm["change"], nm["delta"], nm["yoy_change"], nm["yoy_delta"],
        nm["avg"], nm["max"], nm["min"], nm["avg_change"], nm["cumsum"],
    ]
    out = step3.select(*cols)
    if spec.id_keys:
        out = out.select(surrogate_key(*spec.id_keys).alias("id"), *cols)
    return out


def panel(facts: DataFrame, entities: DataFrame, spec: PanelSpec, params: Params) -> DataFrame:
    """The full panel job, unsorted (hash-partitioned by the entity key)."""
    return window_metrics(grid_counts(facts, entities, spec, params), spec)


def ordered(df: DataFrame, spec: PanelSpec, params: Params) -> DataFrame:
    return df.orderBy(spec.date_col) if params.order_output else df
