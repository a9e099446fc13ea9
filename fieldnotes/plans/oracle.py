"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each model is a named CTE text written from the reference semantics over the
pre-registered test tables; ``sql(final, *ctes)`` prepends the CTEs a query
needs, in dependency order.
"""

from __future__ import annotations

import datetime as dt
import re

from fieldnotes.functions.keys import SURROGATE_NULL_TOKEN
from fieldnotes.operators import order_search as search
from fieldnotes.operators.forecast import step_sql
from fieldnotes.params import FIXTURE_PARAMS, Params

P: Params = FIXTURE_PARAMS


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x: dt.date) -> str:
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


def skey(*exprs: str) -> str:
    parts = [f"coalesce(CAST({e} AS VARCHAR), '{SURROGATE_NULL_TOKEN}')" for e in exprs]
    return "md5(" + " || '-' || ".join(parts) + ")"


LOOKBACK_YEAR = P.as_of.year - P.lookback_years
PREP_YEAR = P.as_of.year - P.prep_lookback_years
SPINE_N = (P.spine_end - P.epoch).days

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


cte("raw", f"""
SELECT
  CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) || printf('%.1f', epoch(greatest(l.l_shipdate, o.o_orderdate)))
    || left(p.p_brand, 3) || right(p.p_brand, 3) AS id,
  CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS inaturalist_id,
  CAST(substr(p.p_brand, 7) AS INTEGER) AS taxon_id,
  p.p_brand AS name,
  'common ' || p.p_brand AS preferred_common_name,
  l.l_shipdate AS observed_date,
  CAST(month(l.l_shipdate) AS DOUBLE) AS observed_month,
  CAST(0 AS DOUBLE) AS observed_hour,
  CAST(weekofyear(l.l_shipdate) AS DOUBLE) AS observed_week,
  CAST(year(l.l_shipdate) AS DOUBLE) AS observed_year,
  CAST(day(l.l_shipdate) AS DOUBLE) AS observed_day,
  greatest(l.l_shipdate, o.o_orderdate) AS updated_at,
  CASE WHEN l.l_suppkey % 3 = 0 THEN 'common ' || p.p_brand WHEN l.l_suppkey % 3 = 1 THEN p.p_name END AS species_guess,
  '{{' || CAST(s.s_nationkey AS VARCHAR) || ',' || CAST(n.n_regionkey AS VARCHAR) || '}}' AS place_ids,
  CAST(CAST(42 + s.s_nationkey * 0.137 AS DECIMAL(12,6)) AS VARCHAR) || ','
    || CAST(CAST(-117 - s.s_nationkey * 0.291 AS DECIMAL(12,6)) AS VARCHAR) AS location,
  CASE l.l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS endemic,
  (l.l_linestatus = 'F') AS native,
  NOT (l.l_linestatus = 'F') AS introduced,
  CASE WHEN l.l_quantity > 40 THEN true WHEN l.l_quantity > 10 THEN false END AS threatened,
  CASE CAST(substr(p.p_brand, 7) AS INTEGER) % 5 WHEN 0 THEN 'genus' WHEN 1 THEN 'subspecies' ELSE 'species' END AS rank,
  'https://example.org/' || p.p_brand AS wikipedia_url,
  CAST(NULL AS BOOLEAN) AS out_of_range,
  CAST(NULL AS BOOLEAN) AS identifications_most_disagree,
  {d(P.as_of)} AS _data_loaded_date
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""")

def staged_ctes(prefix: str, source: str) -> None:
    """``{prefix}_base`` and ``{prefix}``: staging over the CTE ``source``."""
    cte(f"{prefix}_base", f"""
SELECT
  id, inaturalist_id, taxon_id, name AS latin_name, preferred_common_name,
  CAST(date_trunc('day', observed_date) AS TIMESTAMP) AS date_day_observed,
  CAST(observed_month AS INTEGER) AS observed_month,
  CAST(observed_hour AS INTEGER) AS observed_hour,
  CAST(observed_week AS INTEGER) AS observed_week,
  CAST(observed_year AS INTEGER) AS observed_year,
  CAST(observed_day AS INTEGER) AS observed_day,
  updated_at, species_guess,
  (species_guess = preferred_common_name) AS species_guess_correct,
  CAST(string_split(trim(place_ids, '{{}}'), ',') AS INTEGER[]) AS place_id_array,
  CAST(string_split(location, ',') AS DECIMAL(12,6)[]) AS coordinates,
  endemic, native, introduced, threatened, rank, wikipedia_url, _data_loaded_date
FROM {source}
WHERE observed_date >= {ts(P.epoch)} AND observed_date IS NOT NULL""", source)
    cte(prefix, f"""
SELECT *,
  coordinates[1] AS latitude,
  coordinates[2] AS longitude,
  {skey('CAST(round(coordinates[1], 2) AS DECIMAL(12,2))', 'CAST(round(coordinates[2], 2) AS DECIMAL(12,2))')} AS location_id
FROM {prefix}_base""", f"{prefix}_base")


staged_ctes("stg", "raw")

def facts_cte(name: str, staged: str) -> None:
    cte(name, f"""
SELECT *, CAST(date_trunc('month', date_day_observed) AS TIMESTAMP) AS date_month_observed
FROM {staged} WHERE rank IN ('species', 'subspecies')""", staged)


facts_cte("facts", "stg")

cte("numbers", f"SELECT CAST(generate_series AS INTEGER) AS numbers FROM generate_series(0, {SPINE_N})")
cte("dates", f"SELECT CAST({d(P.epoch)} + numbers AS DATE) AS date_day FROM numbers", "numbers")
cte("months", "SELECT DISTINCT CAST(date_trunc('month', date_day) AS TIMESTAMP) AS date_month FROM dates", "dates")

cte("log_bounds", f"""
SELECT CAST(min(date_day_observed) AS DATE) AS first_day, CAST(max(_data_loaded_date) + {P.horizon_days} AS DATE) AS last_day FROM stg""", "stg")
cte("log_numbers", """
SELECT CAST(unnest(generate_series(0, last_day - first_day)) AS INTEGER) AS numbers FROM log_bounds""", "log_bounds")
cte("log_dates", """
SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_day FROM log_bounds""", "log_bounds")
cte("log_months", "SELECT DISTINCT CAST(date_trunc('month', date_day) AS TIMESTAMP) AS date_month FROM log_dates", "log_dates")


def species_cte(name: str, staged: str) -> None:
    cte(name, f"""
SELECT taxon_id, latin_name, preferred_common_name,
  MAX(date_day_observed) AS most_recent_observed_date,
  MIN(date_day_observed) AS first_observed_date,
  MAX(rank) AS rank,
  MAX(wikipedia_url) AS wikipedia_url
FROM {staged} WHERE rank IN ('species', 'subspecies')
GROUP BY 1, 2, 3""", staged)


species_cte("species", "stg")

def species_to_locations_cte(name: str, staged: str) -> None:
    cte(name, f"""
SELECT DISTINCT
  {skey('taxon_id', 'location_id')} AS id,
  location_id, taxon_id, latin_name, preferred_common_name,
  MAX(date_day_observed) OVER (PARTITION BY {staged}.id) AS most_recent_observation_date,
  MIN(date_day_observed) OVER (PARTITION BY {staged}.id) AS first_observation_date
FROM {staged}""", staged)


species_to_locations_cte("species_to_locations", "stg")

cte("species_to_locations_by_key", f"""
SELECT {skey('taxon_id', 'location_id')} AS id, location_id, taxon_id, latin_name, preferred_common_name,
  MAX(date_day_observed) AS most_recent_observation_date,
  MIN(date_day_observed) AS first_observation_date
FROM stg GROUP BY 1, 2, 3, 4, 5""", "stg")


def _period_summary(key_expr: str, key_name: str) -> str:
    return f"""
SELECT
  {key_expr} AS {key_name},
  COUNT(*) AS num_observations,
  COUNT(DISTINCT taxon_id) AS num_taxon_observed,
  CAST(COALESCE(SUM(CAST(species_guess_correct AS INTEGER)), 0) AS BIGINT) AS num_correct_guesses,
  COUNT(DISTINCT CASE WHEN endemic THEN taxon_id END) AS num_endemic_taxon_observed,
  CAST(COALESCE(SUM(CAST(endemic AS INTEGER)), 0) AS BIGINT) AS num_endemic_observations,
  COUNT(DISTINCT CASE WHEN native THEN taxon_id END) AS num_native_taxon_observed,
  CAST(COALESCE(SUM(CAST(native AS INTEGER)), 0) AS BIGINT) AS num_native_observations,
  COUNT(DISTINCT CASE WHEN threatened THEN taxon_id END) AS num_threatened_taxon_observed,
  CAST(COALESCE(SUM(CAST(threatened AS INTEGER)), 0) AS BIGINT) AS num_threatened_observations
FROM stg GROUP BY 1"""


RATIOS = """
  num_correct_guesses / CAST(NULLIF(num_observations, 0) AS DOUBLE) AS pct_observations_guessed_correctly,
  num_endemic_taxon_observed / CAST(NULLIF(num_taxon_observed, 0) AS DOUBLE) AS pct_taxon_endemic,
  num_native_taxon_observed / CAST(NULLIF(num_taxon_observed, 0) AS DOUBLE) AS pct_taxon_native,
  num_threatened_taxon_observed / CAST(NULLIF(num_taxon_observed, 0) AS DOUBLE) AS pct_taxon_threatened"""

cte("daily_agg", _period_summary("date_day_observed", "date_day_observed"), "stg")
cte("monthly_agg", _period_summary("CAST(date_trunc('month', date_day_observed) AS TIMESTAMP)", "date_month_observed"), "stg")
cte("daily_summary", f"""
SELECT dates.date_day, daily_agg.*, {RATIOS}
FROM dates LEFT JOIN daily_agg ON daily_agg.date_day_observed = dates.date_day""", "dates", "daily_agg")
cte("monthly_summary", f"""
SELECT months.date_month, monthly_agg.*, {RATIOS}
FROM months LEFT JOIN monthly_agg ON monthly_agg.date_month_observed = months.date_month""", "months", "monthly_agg")


def _panel_sql(prefix: str, grain: str, entity_cte: str, entity_cols: list[str], join_cols: list[str],
               pkey: str, prior_default: str | None, year_lag: int, window: int,
               pword: str, frame: str, ch: str, id_keys: list[str] | None, carry: list[str], facts: str = "facts") -> None:
    if grain == "day":
        spine = f"SELECT date_day AS d FROM dates WHERE year(date_day) >= {LOOKBACK_YEAR}"
        fact_date = "date_day_observed"
        spine_dep = "dates"
    else:
        spine = f"SELECT date_month AS d FROM months WHERE year(date_month) >= {LOOKBACK_YEAR}"
        fact_date = "date_month_observed"
        spine_dep = "months"
    date_col = "date_day_observed" if grain == "day" else "date_month_observed"
    cte(f"{prefix}_spine", spine, spine_dep)
    ent = ", ".join(f"e.{c}" for c in entity_cols)
    cte(f"{prefix}_grid", f"""
SELECT DISTINCT s.d AS {date_col}, {ent}
FROM {prefix}_spine s CROSS JOIN {entity_cte} e""", f"{prefix}_spine", entity_cte)
    on = " AND ".join([f"f.{fact_date} = g.{date_col}"] + [f"f.{c} = g.{c}" for c in join_cols])
    carry_g = ", ".join(f"g.{c}" for c in carry)
    cte(f"{prefix}_counts", f"""
SELECT g.{date_col}, {carry_g},
  CAST(COALESCE(COUNT(DISTINCT f.inaturalist_id), 0) AS INTEGER) AS num_observations,
  CAST(COALESCE(SUM(CAST(f.species_guess_correct AS INTEGER)), 0) AS INTEGER) AS num_correct_guesses
FROM {prefix}_grid g LEFT JOIN {facts} f ON {on}
GROUP BY ALL""", f"{prefix}_grid", facts)
    rows = f"PARTITION BY {pkey} ORDER BY {date_col}, latin_name, preferred_common_name"
    frame_sql = f"{rows} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
    prior = (f"LAG(num_observations) OVER ({rows})" if prior_default is None
             else f"LAG(num_observations, 1, {prior_default}) OVER ({rows})")
    cte(f"{prefix}_windowed", f"""
SELECT *,
  {prior} AS prior_{pword}_observations,
  LAG(num_observations, {year_lag}, 0) OVER ({rows}) AS one_year_ago_observations,
  AVG(num_observations) OVER ({frame_sql}) AS avg_rolling_{frame}_observations,
  MAX(num_observations) OVER ({frame_sql}) AS max_local_{frame}_observations,
  MIN(num_observations) OVER ({frame_sql}) AS min_local_{frame}_observations
FROM {prefix}_counts""", f"{prefix}_counts")
    carry_s = ", ".join(carry)
    cte(f"{prefix}_changes", f"""
SELECT {date_col}, {carry_s}, num_observations, num_correct_guesses,
  prior_{pword}_observations, one_year_ago_observations,
  (num_observations - prior_{pword}_observations) AS {ch}_observations_change,
  CAST((num_observations - prior_{pword}_observations) // NULLIF(prior_{pword}_observations, 0) AS INTEGER) AS {ch}_observations_delta,
  (num_observations - one_year_ago_observations) AS yoy_observations_change,
  CAST((num_observations - one_year_ago_observations) // NULLIF(one_year_ago_observations, 0) AS INTEGER) AS yoy_observations_delta,
  avg_rolling_{frame}_observations, max_local_{frame}_observations, min_local_{frame}_observations
FROM {prefix}_windowed""", f"{prefix}_windowed")
    idsel = f"{skey(*id_keys)} AS id, " if id_keys else ""
    cte(prefix, f"""
SELECT {idsel}*
FROM (
  SELECT *,
    AVG({ch}_observations_change) OVER ({frame_sql}) AS avg_rolling_{frame}_{ch}_observations_change,
    CAST(SUM({ch}_observations_change) OVER (PARTITION BY {pkey} ORDER BY {date_col}) AS BIGINT)
      AS cumulative_sum_{ch}_observations_change
  FROM {prefix}_changes
) t
WHERE {date_col} < {d(P.as_of)}""", f"{prefix}_changes")


SPECIES_COLS = ["taxon_id", "latin_name", "preferred_common_name"]
_panel_sql("daily_species_summary", "day", "species", SPECIES_COLS, ["taxon_id"], "taxon_id", None, 365, 7,
           "day", "seven_day", "dod", None, SPECIES_COLS)


def monthly_panels(suffix: str, facts: str) -> None:
    """Both monthly panels over the facts, the species and the places with this suffix."""
    _panel_sql(f"monthly_species_summary{suffix}", "month", f"species{suffix}", SPECIES_COLS, ["taxon_id"], "taxon_id", "0", 12, 3,
               "month", "three_month", "mom", ["taxon_id", "date_month_observed"], SPECIES_COLS, facts)
    cte(f"species_locations{suffix}", f"""
SELECT id AS species_location_id, taxon_id, location_id, latin_name, preferred_common_name
FROM species_to_locations{suffix}""", f"species_to_locations{suffix}")
    _panel_sql(f"monthly_species_summary_by_location{suffix}", "month", f"species_locations{suffix}",
               ["species_location_id", "taxon_id", "location_id", "latin_name", "preferred_common_name"],
               ["taxon_id", "location_id"], "species_location_id", "0", 12, 3, "month", "three_month", "mom",
               ["species_location_id", "date_month_observed"],
               ["species_location_id", "taxon_id", "latin_name", "preferred_common_name"], facts)


monthly_panels("", "facts")

cte("weekly_species_summary", """
SELECT *,
  CAST(y - one_year_ago_y AS DOUBLE) / CAST(COALESCE(NULLIF(one_year_ago_y, 0), 1) AS DOUBLE) AS yoy_delta
FROM (
  SELECT *, LAG(y, 52) OVER (PARTITION BY unique_id ORDER BY ds) AS one_year_ago_y
  FROM (
    SELECT taxon_id AS unique_id,
      CAST(date_trunc('week', date_day_observed + INTERVAL 1 DAY) - INTERVAL 1 DAY AS TIMESTAMP) AS ds,
      CAST(SUM(num_observations) AS BIGINT) AS y
    FROM daily_species_summary GROUP BY 1, 2
  ) w
) l""", "daily_species_summary")

cte("forecast_prep_species", f"""
SELECT ds, unique_id, y FROM (
  SELECT date_month_observed AS ds, taxon_id AS unique_id, num_observations AS y,
    SUM(num_observations) OVER (PARTITION BY taxon_id) AS total
  FROM monthly_species_summary
  WHERE year(date_month_observed) >= {PREP_YEAR}
) t WHERE total > {P.min_total_species}""", "monthly_species_summary")

cte("forecast_prep_species_location", f"""
SELECT ds, unique_id, y FROM (
  SELECT date_month_observed AS ds, species_location_id AS unique_id, num_observations AS y,
    SUM(num_observations) OVER (PARTITION BY species_location_id) AS total
  FROM monthly_species_summary_by_location
  WHERE year(date_month_observed) >= {PREP_YEAR}
) t WHERE total > {P.min_total_species_location}""", "monthly_species_summary_by_location")

cte("day_of_week_summary", f"""
SELECT ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][int_day_of_week + 1] AS _day_of_week,
  num_observations
FROM (
  SELECT CAST(dayofweek(date_day_observed) AS INTEGER) AS int_day_of_week, COUNT(*) AS num_observations
  FROM stg WHERE date_day_observed >= {ts(P.dow_since)} GROUP BY 1
) dow ORDER BY int_day_of_week""", "stg")


# ---------------------------------------------------------------------------
# Incremental ingest scenario: a first load, then a pull from its high-water mark
# ---------------------------------------------------------------------------
RAW_COLS = [
    "inaturalist_id", "taxon_id", "name", "preferred_common_name", "observed_date", "observed_month",
    "observed_hour", "observed_week", "observed_year", "observed_day", "updated_at", "species_guess",
    "place_ids", "location", "endemic", "native", "introduced", "threatened", "rank", "wikipedia_url",
    "out_of_range", "identifications_most_disagree", "_data_loaded_date",
]
RAW_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_COLS)
PLACE_ARRAY = "CAST(string_split(trim(place_ids, '{}'), ',') AS INTEGER[])"


def dedupe_sql(source: str) -> str:
    """One row per id: the smallest row comparing the other columns in order."""
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY id ORDER BY {RAW_ORDER}) = 1"


cte("stored", f"SELECT * FROM raw WHERE updated_at < {ts(P.first_load_before)}", "raw")
cte("hwm", "SELECT strftime(max(updated_at), '%Y-%m-%d') AS high_water_mark FROM stored", "stored")
cte("fetched", """
SELECT raw.* FROM raw, hwm
WHERE hwm.high_water_mark IS NULL OR raw.updated_at >= CAST(CAST(hwm.high_water_mark AS DATE) AS TIMESTAMP)""",
    "raw", "hwm")
cte("fetched_dedup", dedupe_sql("fetched"), "fetched")
cte("stored_dedup", dedupe_sql("stored"), "stored")
cte("new_rows", """
SELECT * FROM fetched_dedup f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.id = f.id)""",
    "fetched_dedup", "stored")
staged_ctes("stg_stored", "stored")
staged_ctes("stg_new", "new_rows")
species_cte("species_stored", "stg_stored")
species_cte("species_new", "stg_new")
# the log after the increment, and the four incremental models over it
cte("increment", """
SELECT * FROM stored_dedup UNION ALL SELECT * FROM new_rows""", "stored_dedup", "new_rows")
staged_ctes("stg_increment", "increment")
facts_cte("facts_increment", "stg_increment")
species_cte("species_increment", "stg_increment")
species_to_locations_cte("species_to_locations_increment", "stg_increment")
monthly_panels("_increment", "facts_increment")

cte("places", "SELECT * FROM (VALUES " + ", ".join(f"({p})" for p in P.places) + ") t(place_id)")
cte("landed", f"""
SELECT places.place_id, raw.* FROM raw, places
WHERE list_contains({PLACE_ARRAY}, places.place_id)""", "raw", "places")
cte("landed_union", dedupe_sql("(SELECT * EXCLUDE (place_id) FROM landed)"), "landed")

# ---------------------------------------------------------------------------
# Forecast baseline (seasonal naive) over the trimmed prep series
# ---------------------------------------------------------------------------
AS_OF_MONTH = P.as_of.replace(day=1)
Z90 = "1.6448536269514722"


def naive_ctes(prefix: str, prep: str) -> None:
    cte(f"{prefix}_series", f"""
SELECT CAST(unique_id AS VARCHAR) AS unique_id, ds, y FROM {prep} WHERE ds < {ts(AS_OF_MONTH)}""", prep)
    cte(f"{prefix}_stats", f"""
SELECT unique_id, max(ds) AS last_ds, sqrt(avg(e * e)) AS s FROM (
  SELECT unique_id, ds, y - LAG(y, {P.season}) OVER (PARTITION BY unique_id ORDER BY ds) AS e
  FROM {prefix}_series
) t GROUP BY 1""", f"{prefix}_series")
    steps = []
    for k in range(1, P.h + 1):
        back = (k - 1) % P.season + 1 - P.season
        steps.append(f"SELECT unique_id, s, CAST({k} AS INTEGER) AS h, CAST(last_ds + to_months({back}) AS TIMESTAMP) AS src_ds, "
                     f"CAST(last_day(last_ds + to_months({k})) AS TIMESTAMP) AS ds FROM {prefix}_stats")
    cte(f"{prefix}_steps", "\nUNION ALL\n".join(steps), f"{prefix}_stats")
    cte(prefix, f"""
SELECT st.unique_id, st.ds,
  CAST(se.y AS DOUBLE) AS y_hat,
  CAST(se.y AS DOUBLE) - {Z90} * st.s AS y_hat_lo,
  CAST(se.y AS DOUBLE) + {Z90} * st.s AS y_hat_hi
FROM {prefix}_steps st LEFT JOIN {prefix}_series se ON se.unique_id = st.unique_id AND se.ds = st.src_ds""",
        f"{prefix}_steps", f"{prefix}_series")


def lsq_ctes(prefix: str, prep: str) -> None:
    """Least squares of the seasonal change on the one a month before, from whole-number sums."""
    cte(f"{prefix}_diffs", f"""
SELECT *, LAG(z) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM (
  SELECT CAST(unique_id AS VARCHAR) AS unique_id, ds, CAST(y AS BIGINT) AS y,
    CAST(y - LAG(y, {P.season}) OVER (PARTITION BY unique_id ORDER BY ds) AS BIGINT) AS z
  FROM {prep} WHERE ds < {ts(AS_OF_MONTH)}) t""", prep)
    cte(f"{prefix}_sums", f"""
SELECT unique_id, max(ds) AS last_ds, arg_max(z, ds) AS last_z,
  sum(1) FILTER (WHERE x IS NOT NULL AND z IS NOT NULL) AS n, sum(x) FILTER (WHERE z IS NOT NULL) AS sx, sum(z) FILTER (WHERE x IS NOT NULL) AS sz,
  sum(x * x) FILTER (WHERE z IS NOT NULL) AS sxx, sum(x * z) AS sxz, sum(z * z) FILTER (WHERE x IS NOT NULL) AS szz
FROM {prefix}_diffs GROUP BY 1""", f"{prefix}_diffs")
    cte(f"{prefix}_line", f"""
SELECT *, CAST(last_z AS DOUBLE) AS e, (CAST(sz AS DOUBLE) - b * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS a FROM (
  SELECT *, CAST(n * sxz - sx * sz AS DOUBLE) / CAST(nullif(n * sxx - sx * sx, 0) AS DOUBLE) AS b FROM {prefix}_sums) t""", f"{prefix}_sums")
    cte(f"{prefix}_fit", f"""
SELECT *, CASE WHEN b IS NOT NULL THEN
  greatest(CAST(0 AS DOUBLE), CAST(szz AS DOUBLE) - a * CAST(sz AS DOUBLE) - b * CAST(sxz AS DOUBLE)) / CAST(n AS DOUBLE) END AS s2
FROM {prefix}_line""", f"{prefix}_line")
    steps = []
    for k in range(1, P.h + 1):
        change, spread = step_sql(k, P.season)
        back = (k - 1) % P.season + 1 - P.season
        steps.append(f"SELECT unique_id, CAST(last_ds + to_months({back}) AS TIMESTAMP) AS src_ds, "
                     f"CAST(last_day(last_ds + to_months({k})) AS TIMESTAMP) AS ds, {change} AS change, sqrt({spread}) AS spread FROM {prefix}_fit")
    cte(f"{prefix}_steps", "\nUNION ALL\n".join(steps), f"{prefix}_fit")
    cte(prefix, f"""
SELECT st.unique_id, st.ds, CAST(se.y AS DOUBLE) + st.change AS y_hat,
  CAST(se.y AS DOUBLE) + st.change - {Z90} * st.spread AS y_hat_lo,
  CAST(se.y AS DOUBLE) + st.change + {Z90} * st.spread AS y_hat_hi
FROM {prefix}_steps st LEFT JOIN {prefix}_diffs se ON se.unique_id = st.unique_id AND se.ds = st.src_ds""",
        f"{prefix}_steps", f"{prefix}_diffs")


def layered(prefix: str, source: str, layers: list[dict[str, str]]) -> str:
    """One CTE for each layer, the first one over ``source``; the name of the last."""
    for i, layer in enumerate(layers):
        name = f"{prefix}_{i}"
        cte(name, f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in layer.items())} FROM {source}", source)
        source = name
    return source


def search_ctes(prefix: str, prep: str) -> None:
    """The order search: sums of products of the lags, elimination, and the least AICc."""
    season, h = P.season, P.h
    lags = ", ".join(f"LAG(y0, {i}) OVER w AS y{i}" for i in search.lags_needed(season, h) if i)
    cte(f"{prefix}_lags", f"""
SELECT *, {lags} FROM (
  SELECT CAST(unique_id AS VARCHAR) AS unique_id, ds, CAST(y AS BIGINT) AS y0 FROM {prep} WHERE ds < {ts(AS_OF_MONTH)}) t
WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
QUALIFY y{season + search.MAX_D} IS NOT NULL""", prep)
    cte(f"{prefix}_months", "\nUNION ALL\n".join(
        f"SELECT unique_id, ds, {d} AS d, {', '.join(f'{e} AS {n}' for n, e in search.places(d, season, h).items())} FROM {prefix}_lags"
        for d in range(search.MAX_D + 1)), f"{prefix}_lags")
    sums = ", ".join(f"CAST(sum(v{i} * v{j}) AS BIGINT) AS s_{i}{j}" for i, j in search.PAIRS)
    last = ", ".join(f"arg_max({n}, ds) AS {n}" for n in search.kept(season, h))
    cte(f"{prefix}_sums", f"SELECT unique_id, d, max(ds) AS end_ds, {sums}, {last} FROM {prefix}_months GROUP BY ALL", f"{prefix}_months")
    cte(f"{prefix}_both", f"SELECT *, 0 AS s FROM {prefix}_sums UNION ALL SELECT *, 1 AS s FROM {prefix}_sums", f"{prefix}_sums")
    fits = layered(f"{prefix}_elimination", f"{prefix}_both", search.elimination())
    cte(f"{prefix}_candidates", "\nUNION ALL\n".join(f"SELECT *, {p} AS p, rss{p} AS rss FROM {fits}" for p in range(search.MAX_P + 1)), fits)
    rated = layered(f"{prefix}_criterion", f"{prefix}_candidates", search.criterion())
    cte(f"{prefix}_best", f"""
SELECT * FROM {rated} WHERE aicc IS NOT NULL QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY aicc, k, d, s, p) = 1""", rated)
    cte(f"{prefix}_chosen", f"""
SELECT e.unique_id, e.end_ds, b.* EXCLUDE (unique_id, end_ds)
FROM (SELECT unique_id, max(end_ds) AS end_ds FROM {prefix}_sums GROUP BY 1) e LEFT JOIN {prefix}_best b ON b.unique_id = e.unique_id""",
        f"{prefix}_sums", f"{prefix}_best")
    run = layered(f"{prefix}_forward", f"{prefix}_chosen", search.coefficients() + search.forward(season, h))
    step = f"""SELECT unique_id, CAST(last_day(end_ds + to_months({{k}})) AS TIMESTAMP) AS ds, x{{k}} AS y_hat,
  x{{k}} - {Z90} * sqrt(s2 * u{{k}}) AS y_hat_lo, x{{k}} + {Z90} * sqrt(s2 * u{{k}}) AS y_hat_hi FROM {run}"""
    cte(prefix, "\nUNION ALL\n".join(step.format(k=k) for k in range(1, h + 1)), run)


search_ctes("search_species", "forecast_prep_species")
search_ctes("search_location", "forecast_prep_species_location")
naive_ctes("naive_species", "forecast_prep_species")
lsq_ctes("lsq_species", "forecast_prep_species")
lsq_ctes("lsq_location", "forecast_prep_species_location")
naive_ctes("naive_location", "forecast_prep_species_location")


def sql(final: str, *names: str) -> str:
    """``WITH`` the named CTEs (and their dependencies) followed by ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    uses = re.findall(r"\w+", " ".join([final, *(CTES[n][0] for n in order)]))
    shared = {n: " MATERIALIZED" if uses.count(n) > 1 else "" for n in order}
    body = ",\n".join(f"{n} AS{shared[n]} ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def model(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)
