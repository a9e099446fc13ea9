"""Forecasts by a search over autoregressive orders, per series, in built-ins.

Candidates: ``d`` ordinary differences (0-2), ``p`` lags (0-3) and ``s`` seasonal lags
(0 or 1) of the differenced series, with a constant. All are fitted by least squares on
the same months (those with every lag there is), so their AICc can be compared:

1. one window gives each month its lags, one partial aggregation per (series, d) the sums
   of products of target, lags and constant: whole numbers, exact in any order;
2. Gaussian elimination of the symmetric sums, written as layers of plain arithmetic:
   with the seasonal lag (or without it) first and the lags after it, one elimination
   leaves the residual sums of squares of all four ``p``. A pivot that is nothing but
   rounding ends it: what would need it is no candidate;
3. the candidate of least AICc (rounded, ties to fewer parameters, then smaller d, s, p)
   is solved backwards, run forward ``h`` months and summed up ``d`` times. Bounds are
   normal, from the squared weights of past errors.

The layers are SQL text that every engine reads alike, so the oracle runs the same
arithmetic; a test holds it against a least-squares library.

Defined cases: series are dense (a row a month); one shorter than ``season + 3`` months
has no rows, one without a candidate (too few months for any) has NULL forecasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.operators.forecast import future_dates, params_z
from fieldnotes.params import Params

MAX_D, MAX_P = 2, 3
CONST, SEASONAL, FIRST_LAG, TARGET = 0, 1, 2, 2 + MAX_P  # places of the eliminated matrix
PIVOT = "1e-9"  # a pivot below this part of its first value is rounding
LEAST_VARIANCE = "1e-6"  # for the logarithm of a perfect fit
Layer = dict[str, str]


def difference(d: int, lag: int) -> str:
    """The ``d``-th difference ``lag`` months back, from the lags y0, y1, ..."""
    return (f"y{lag}", f"y{lag} - y{lag + 1}", f"y{lag} - 2 * y{lag + 1} + y{lag + 2}")[d]


def lags_needed(season: int, h: int) -> list[int]:
    return sorted({*range(MAX_P + MAX_D + 1), *range(max(season - h, 0), season + MAX_D + 1)})


def places(d: int, season: int, h: int) -> Layer:
    """The regressors v0 .. v5 of a month, and what a forecast after it needs: the last differences l0.. and those of a season before, b1.. ."""
    v = {"v0": "CAST(1 AS BIGINT)", "v1": difference(d, season), **{f"v{1 + i}": difference(d, i) for i in range(1, MAX_P + 1)}, f"v{TARGET}": difference(d, 0)}
    last = {f"l{i}": difference(d, i) for i in range(MAX_P)}
    before = {f"b{k}": difference(d, season - k) for k in range(1, min(h, season) + 1)}
    return v | last | before | {"last_y": "y0", "last_change": "y0 - y1"}


def kept(season: int, h: int) -> list[str]:
    """Names of what is taken from the last month of a series."""
    return [n for n in places(0, season, h) if not n.startswith("v")]


PAIRS = [(i, j) for i in range(TARGET + 1) for j in range(i, TARGET + 1)]


def elimination() -> list[Layer]:
    """From the sums s_ij and the flag ``s``: multipliers f_kj, and the residual sum of squares r_p of each p."""
    layers = [{f"m0_{i}{j}": f"CAST(s_{i}{j} AS DOUBLE)" for i, j in PAIRS}]
    for k in range(TARGET):
        pivot = f"CASE WHEN m{k}_{k}{k} > {PIVOT} * m0_{k}{k} THEN m{k}_{k}{k} END"
        factor = "CASE WHEN s = 1 THEN m{k}_{k}{j} / p{k} ELSE CAST(0 AS DOUBLE) END" if k == SEASONAL else "m{k}_{k}{j} / p{k}"
        layers.append({f"p{k}": pivot})
        layers.append({f"f_{k}{j}": factor.format(k=k, j=j) for j in range(k + 1, TARGET + 1)})
        layers.append({f"m{k + 1}_{i}{j}": f"m{k}_{i}{j} - f_{k}{i} * m{k}_{k}{j}" for i, j in PAIRS if i > k})
    layers.append({f"r{p}": f"greatest(CAST(0 AS DOUBLE), m{2 + p}_{TARGET}{TARGET})" for p in range(MAX_P + 1)})
    # greatest() skips NULLs, which mean that a pivot was missing
    layers.append({f"rss{p}": f"CASE WHEN m{2 + p}_{TARGET}{TARGET} IS NOT NULL THEN r{p} END" for p in range(MAX_P + 1)})
    return layers


def criterion() -> list[Layer]:
    """From n, rss, p and s: the number of parameters and the AICc, rounded."""
    return [
        {"k": "p + s + 2", "n": "CAST(s_00 AS DOUBLE)"},
        {"s2": "rss / n"},
        {"aicc": f"CASE WHEN n > k + 1 THEN round(n * ln(greatest(s2, {LEAST_VARIANCE})) + 2 * k + CAST(2 * k * (k + 1) AS DOUBLE) / (n - k - 1), 6) END"},
    ]


def coefficients() -> list[Layer]:
    """c0 .. c4 of the chosen order, backwards; those it does not have are 0."""
    layers = []
    for k in range(TARGET - 1, -1, -1):
        has = {CONST: "true", SEASONAL: "s = 1"}.get(k, f"p >= {k - FIRST_LAG + 1}")
        solved = " - ".join([f"f_{k}{TARGET}", *(f"f_{k}{j} * c{j}" for j in range(k + 1, TARGET))])
        layers.append({f"c{k}": f"CASE WHEN {has} THEN {solved} ELSE CAST(0 AS DOUBLE) END"})
    return layers


def forward(season: int, h: int) -> list[Layer]:
    """Forecasts x1 .. xh of the series and the variances u1 .. uh of their errors."""
    layers = [{"x0": "CAST(last_y AS DOUBLE)", "x_1": "CAST(last_y - last_change AS DOUBLE)", "psi0": "CAST(1 AS DOUBLE)", "sum0": "CAST(1 AS DOUBLE)",
               "twice0": "CAST(1 AS DOUBLE)", "u0": "CAST(0 AS DOUBLE)", **{f"w_{i}": f"CAST(l{i} AS DOUBLE)" for i in range(MAX_P)}}]
    past = lambda k: f"w{k}" if k > 0 else f"w_{-k}"  # noqa: E731  differenced values, w_0 the last known
    for k in range(1, h + 1):
        back = f"CAST(b{k} AS DOUBLE)" if k <= season else past(k - season)
        layers.append({f"w{k}": " + ".join(["c0", f"c1 * {back}", *(f"c{1 + i} * {past(k - i)}" for i in range(1, MAX_P + 1))])})
        before = f"x{k - 2}" if k > 1 else "x_1"
        layers.append({f"x{k}": f"CASE d WHEN 0 THEN w{k} WHEN 1 THEN x{k - 1} + w{k} ELSE 2 * x{k - 1} - {before} + w{k} END"})
        weight = f"CASE d WHEN 0 THEN psi{k - 1} WHEN 1 THEN sum{k - 1} ELSE twice{k - 1} END"
        layers.append({f"e{k}": weight})
        terms = [f"c{1 + i} * psi{k - i}" for i in range(1, min(MAX_P, k) + 1)] + [f"c1 * psi{k - season}"] * (k >= season)
        layers.append({f"u{k}": f"u{k - 1} + e{k} * e{k}", f"psi{k}": " + ".join(terms)})
        layers.append({f"sum{k}": f"sum{k - 1} + psi{k}"})
        layers.append({f"twice{k}": f"twice{k - 1} + sum{k}"})
    return layers


def with_layers(df: DataFrame, layers: list[Layer]) -> DataFrame:
    for layer in layers:
        df = df.select("*", *[F.expr(e).alias(n) for n, e in layer.items()])
    return df


def chosen_orders(series: DataFrame, params: Params, keys: tuple[str, ...] = ("unique_id",)) -> DataFrame:
    """The best candidate of every series: keys, d, p, s, n, aicc, s2, its multipliers and what a forecast starts from."""
    season, h, keys = params.season, params.h, list(keys)
    w = Window.partitionBy(*keys).orderBy("ds")
    rows = series.select(*[F.col(k).cast("string").alias(k) for k in keys], "ds", F.col("y").cast("long").alias("y0"))
    rows = rows.select("*", *[F.lag("y0", i).over(w).alias(f"y{i}") for i in lags_needed(season, h) if i]).where(f"y{season + MAX_D} IS NOT NULL")
    each = [F.struct(F.lit(d).alias("d"), *[F.expr(e).alias(n) for n, e in places(d, season, h).items()]) for d in range(MAX_D + 1)]
    rows = rows.select(*keys, "ds", F.explode(F.array(*each)).alias("r")).select(*keys, "ds", "r.*")
    sums = rows.groupBy(*keys, "d").agg(
        F.max("ds").alias("last_ds"), *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s_{i}{j}") for i, j in PAIRS],
        *[F.max_by(n, "ds").alias(n) for n in kept(season, h)])
    fits = with_layers(sums.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("s")), elimination())
    by_p = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"rss{p}").alias("rss")) for p in range(MAX_P + 1)]))
    fits = with_layers(fits.select("*", by_p.alias("c")).select("*", "c.p", "c.rss"), criterion())
    first = ["aicc", "k", "d", "s", "p"]
    rest = ["n", "s2", "last_ds", *kept(season, h), *[f"f_{k}{j}" for k in range(TARGET) for j in range(k + 1, TARGET + 1)]]
    best = F.min(F.when(F.col("aicc").isNotNull(), F.struct(*first, *rest)))
    return fits.groupBy(*keys).agg(best.alias("b"), F.max("last_ds").alias("end_ds")).select(*keys, "end_ds", "b.*")


def order_search(series: DataFrame, params: Params, keys: tuple[str, ...] = ("unique_id",)) -> DataFrame:
    """``FORECAST_CORE`` (and further keys) of every series by its best order."""
    run = with_layers(chosen_orders(series, params, keys), coefficients() + forward(params.season, params.h))
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"x{k}").alias("x"), F.sqrt(F.col("s2") * F.col(f"u{k}")).alias("e")) for k in range(1, params.h + 1)])
    steps = run.select(*keys, "end_ds", F.explode(steps).alias("f"))
    z = F.lit(params_z(params.level))
    return steps.select("unique_id", future_dates(F.col("end_ds"), F.col("f.k")).alias("ds"), F.col("f.x").alias("y_hat"),
                        (F.col("f.x") - z * F.col("f.e")).alias("y_hat_lo"), (F.col("f.x") + z * F.col("f.e")).alias("y_hat_hi"),
                        *[k for k in keys if k != "unique_id"])
