import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldnotes.operators import forecast
from fieldnotes.params import Params

P = Params(as_of=dt.date(2001, 10, 15))


def _series(spark, values, uid="7", start="1998-01-01"):
    ds = pd.date_range(start, periods=len(values), freq="MS")
    rows = [(uid, d.to_pydatetime(), int(v)) for d, v in zip(ds, values)]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y int")


def test_trim_partial_drops_the_current_month(spark):
    s = _series(spark, range(46))  # Jan 1998 .. Oct 2001
    assert forecast.trim_partial(s, P).agg(F.max("ds")).first()[0] == dt.datetime(2001, 9, 1)


def test_seasonal_naive_repeats_last_season_with_bounds(spark):
    vals = [10 + (i % 12) for i in range(36)]  # perfectly seasonal: zero spread
    out = forecast.seasonal_naive(_series(spark, vals), P).orderBy("ds").collect()
    assert [r.ds for r in out] == [dt.datetime(2001, 1, 31), dt.datetime(2001, 2, 28),
                                   dt.datetime(2001, 3, 31), dt.datetime(2001, 4, 30)]
    assert [r.y_hat for r in out] == [10.0, 11.0, 12.0, 13.0]
    assert all(r.y_hat_lo == r.y_hat == r.y_hat_hi for r in out)


def test_future_dates_are_month_ends(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1),)], "d timestamp_ntz")
    got = [df.select(forecast.future_dates(F.col("d"), F.lit(k)).alias("x")).first().x for k in (1, 2)]
    assert got == [dt.datetime(2001, 2, 28), dt.datetime(2001, 3, 31)]


def test_grouped_forecast_by_hand(spark):
    """Least squares of the seasonal change on the one before it, against the closed form on the same numbers."""
    vals = [5 + (i % 12) + (i * i) % 7 + i // 6 for i in range(40)]
    short = [3, 4, 2, 5, 4, 3, 6, 2]  # no season to compare with
    flat = [1 + i % 12 for i in range(40)]  # no change at all: the sums give no line
    s = _series(spark, vals, "a").unionByName(_series(spark, short, "b")).unionByName(_series(spark, flat, "c"))
    for h in (4, 15):
        p = Params(as_of=P.as_of, h=h)
        out = {}
        for r in forecast.grouped_forecast(s, p).orderBy("ds").collect():
            out.setdefault(r.unique_id, []).append(r)
        assert {k: len(v) for k, v in out.items()} == {"a": h, "b": h, "c": h}
        assert all(r.y_hat is None and r.y_hat_lo is None for k in "bc" for r in out[k])
        z = [vals[i] - vals[i - 12] for i in range(12, 40)]
        x, t = z[:-1], z[1:]
        n, mx, mt = len(x), sum(x) / len(x), sum(t) / len(t)
        slope = sum((i - mx) * (j - mt) for i, j in zip(x, t)) / sum((i - mx) ** 2 for i in x)
        cut = mt - slope * mx
        s2 = sum((j - cut - slope * i) ** 2 for i, j in zip(x, t)) / n
        level, change, grown, spread = list(vals), z[-1], 0.0, []
        for k in range(h):
            change = cut + slope * change
            level.append(level[-12] + change)
            grown = 1 + slope * slope * grown
            spread.append(grown + (spread[k - 12] if k >= 12 else 0))
        for r, y, v in zip(out["a"], level[40:], spread):
            assert abs(r.y_hat - y) < 1e-9 and abs(r.y_hat_hi - y - forecast.Z90 * (s2 * v) ** 0.5) < 1e-9
            assert abs(r.y_hat - r.y_hat_lo - (r.y_hat_hi - r.y_hat)) < 1e-9
            assert (r.ds + dt.timedelta(days=1)).day == 1  # month end


def test_seasonal_naive_repeats_the_season(spark):
    out = forecast.seasonal_naive(_series(spark, [10 + i % 12 for i in range(36)]), Params(as_of=P.as_of, h=15)).orderBy("ds").collect()
    assert [r.y_hat for r in out] == [float(10 + i % 12) for i in range(15)]


def test_forecast_type_is_cut_from_the_query_text(spark):
    text = "SELECT 1\nFROM public.forecast_prep__monthly_species_summary_by_location"
    df = spark.createDataFrame([(text,)], "q string")
    assert df.select(forecast.forecast_type_of(F.col("q")).alias("t")).first().t == "monthly_species_summary_by_location"


def test_stamp_takes_the_level_of_its_names(spark):
    core = forecast.seasonal_naive(_series(spark, list(range(30))), P)
    with pytest.raises(ValueError):
        forecast.stamp(core, "x", P.as_of, level=80)


def test_thresholds_are_strict(spark):
    """Series with totals 10, 11, 20 and 21: more than the threshold, not as much."""
    rows = [(u, dt.datetime(2001, m, 1), n) for u, total in ((1, 10), (2, 11), (3, 20), (4, 21)) for m, n in ((1, total - 4), (2, 4))]
    panel = spark.createDataFrame(rows, "taxon_id int, date_month_observed timestamp_ntz, num_observations int")
    left = lambda n: {r.unique_id for r in forecast.prep(panel, "taxon_id", n, P).collect()}
    assert left(P.min_total_species) == {2, 3, 4} and left(P.min_total_species_location) == {4}


def test_stamp_conforms_to_stored_schema(spark):
    core = forecast.seasonal_naive(_series(spark, list(range(30))), P)
    out = forecast.stamp(core, "monthly_species_summary", P.as_of)
    assert out.columns == ["ds", "unique_id", "auto_arima", "auto_arima_lo_90", "auto_arima_hi_90",
                           "forecast_type", "_date_forecasted"]
    assert out.first()._date_forecasted == P.as_of


def _search_by_library(vals, season=12):
    """The order search with numpy's least squares: (d, p, s, forecasts, half widths)."""
    import numpy as np

    best = None
    for d in range(3):
        w = np.diff(np.array(vals, float), d)
        first = season + 2 - d  # the same months for every candidate
        for s in (0, 1):
            for p in range(4):
                t = np.arange(first, len(w))
                x = np.stack([np.ones(len(t)), *([w[t - season]] * s), *(w[t - i] for i in range(1, p + 1))], 1)
                if np.linalg.matrix_rank(x) < x.shape[1]:
                    continue
                c, *_ = np.linalg.lstsq(x, w[t], rcond=None)
                n, k = len(t), p + s + 2
                s2 = ((w[t] - x @ c) ** 2).sum() / n
                aicc = round(n * np.log(max(s2, 1e-6)) + 2 * k + 2 * k * (k + 1) / (n - k - 1), 6)
                if best is None or (aicc, k, d, s, p) < best[0]:
                    best = ((aicc, k, d, s, p), w, c, s2)
    (aicc, k, d, s, p), w, c, s2 = best
    w, y, psi = list(w), list(map(float, vals)), [1.0]
    for h in range(4):
        w.append(c[0] + (c[1] * w[-season] if s else 0) + sum(c[s + i] * w[-i] for i in range(1, p + 1)))
        y.append(w[-1] + (0, y[-1], 2 * y[-1] - y[-2])[d])
        psi.append(sum(c[s + i] * psi[-i] for i in range(1, min(p, len(psi)) + 1)))
    weights = psi[:4]
    for _ in range(d):
        weights = list(np.cumsum(weights))
    half = forecast.Z90 * np.sqrt(s2 * np.cumsum(np.square(weights)))
    return d, p, s, aicc, y[-4:], half


def _autoregressive(seed, coefficients, n, d=0, scale=1000, season=0):
    import numpy as np

    rng = np.random.default_rng(seed)
    w = list(rng.normal(0, scale, 20))
    for _ in range(n + 40):
        w.append(sum(c * w[-1 - i] for i, c in enumerate(coefficients)) + (season and 0.8 * w[-12]) + rng.normal(0, scale / 10))
    w = np.array(w[-n:])
    for _ in range(d):
        w = np.cumsum(w)
    return np.round(w).astype(int) + 50_000


def test_order_search_against_least_squares(spark):
    """Every series gets the order, forecasts and bounds that a library gives; AR(2) and its differences are found."""
    from fieldnotes.operators import order_search

    made = {"ar2": _autoregressive(1, (0.5, -0.8), 60), "ar2 summed": _autoregressive(6, (0.5, -0.8), 60, 1),
            "ar2 summed twice": _autoregressive(6, (0.4, -0.8), 60, 2), "seasonal": _autoregressive(4, (0.0,), 60, season=1),
            "noise": _autoregressive(5, (0.0,), 45), "ar3": _autoregressive(6, (0.3, 0.2, -0.7), 80)}
    s = None
    for uid, vals in made.items():
        one = _series(spark, vals, uid, "1996-01-01")
        s = one if s is None else s.unionByName(one)
    orders = {r.unique_id: r for r in order_search.chosen_orders(s, P).collect()}
    found = {}
    for r in order_search.order_search(s, P).orderBy("ds").collect():
        found.setdefault(r.unique_id, []).append(r)
    for uid, vals in made.items():
        d, p, seasonal, aicc, y, half = _search_by_library(vals)
        o = orders[uid]
        assert (o.d, o.p, o.s) == (d, p, seasonal) and abs(o.aicc - aicc) < 1e-4, uid
        for r, x, e in zip(found[uid], y, half):
            assert abs(r.y_hat - x) < 1e-4 * abs(x) and abs(r.y_hat_hi - r.y_hat - e) < 1e-4 * e and abs(r.y_hat - r.y_hat_lo - e) < 1e-4 * e
    assert (orders["ar2"].d, orders["ar2"].p) == (0, 2) and (orders["ar2 summed"].d, orders["ar2 summed"].p) == (1, 2)
    assert orders["ar2 summed twice"].d == 2 and orders["seasonal"].s == 1


def test_order_search_of_short_and_exact_series(spark):
    from fieldnotes.operators import order_search

    s = _series(spark, range(14), "short").unionByName(_series(spark, range(16), "few")).unionByName(_series(spark, [5] * 40, "flat")).unionByName(
        _series(spark, [3 * i + 7 for i in range(40)], "line"))
    out = {}
    for r in order_search.order_search(s, P).orderBy("ds").collect():
        out.setdefault(r.unique_id, []).append(r)
    assert set(out) == {"few", "flat", "line"}
    assert [r.y_hat for r in out["few"]] == [None] * 4 and len(out["few"]) == 4
    assert [r.y_hat for r in out["flat"]] == [5.0] * 4 and all(r.y_hat_lo == r.y_hat_hi == 5.0 for r in out["flat"])
    assert all(abs(r.y_hat - (3 * i + 7)) < 1e-6 for i, r in enumerate(out["line"], 40))
    assert order_search.order_search(s.where("false"), P).count() == 0


def test_model_map_runs_a_callers_model(spark):
    """A numpy model over several series; the one that raises and the one of another shape are reported, the others go on."""
    import numpy as np

    from fieldnotes.operators import model_map

    def drift(ds, y, h):
        if y[0] == 13:
            raise ZeroDivisionError("thirteen")
        if y[0] == 14:
            return y[:1], y[:1], y[:1]
        point = y[-1] + (y[-1] - y[0]) / (len(y) - 1) * np.arange(1, h + 1)
        return point, point - 1, point + 1

    s = _series(spark, range(0, 60, 2), "a").unionByName(_series(spark, [13, 1], "b")).unionByName(_series(spark, [14, 1], "c")).repartition(5)
    out = {}
    for r in model_map.map_models(s, drift, P).orderBy("ds").collect():
        out.setdefault(r.unique_id, []).append(r)
    assert [(r.y_hat, r.y_hat_lo, r.failure) for r in out["a"]] == [(60.0 + 2 * i, 59.0 + 2 * i, None) for i in range(4)]
    assert [r.failure for r in out["b"]] == ["ZeroDivisionError: thirteen"] * 4 and [r.y_hat for r in out["b"]] == [None] * 4
    assert [r.failure for r in out["c"]] == ["ValueError: not three arrays of 4 values"] * 4
    assert model_map.map_models(s.where("false"), drift, P).count() == 0
    stamped = forecast.stamp(model_map.as_fit(drift)(s, P, ("unique_id",)), "own", P.as_of)
    assert stamped.where("auto_arima IS NULL").count() == 8 and stamped.count() == 12


def test_spines_follow_the_log(spark, raw_df):
    from tests.support import raw_row, ts

    from fieldnotes.plans.models import Models

    raw = raw_df([raw_row(inaturalist_id=i, observed_date=ts(d)) for i, d in enumerate(("2001-08-30 05:00:00", "2001-09-02 00:00:00"))])
    m = Models(spark, raw, Params(as_of=dt.date(2001, 9, 3), epoch=dt.date(2001, 1, 1), horizon_days=30))
    days = [r.date_day for r in m.log_dates.orderBy("date_day").collect()]
    assert days[0] == dt.date(2001, 8, 30) and days[-1] == dt.date(2001, 11, 14) and len(days) == 77  # 30 days past the load of the rows
    assert [r.numbers for r in m.log_numbers.orderBy("numbers").collect()] == list(range(77))
    assert [r.date_month.month for r in m.log_months.orderBy("date_month").collect()] == [8, 9, 10, 11]
    none = Models(spark, raw.where("false"), P)
    assert none.log_dates.count() == none.log_numbers.count() == none.log_months.count() == 0
