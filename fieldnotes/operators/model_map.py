"""A caller's forecasting model, run once per series by grouped map.

``fit_predict(ds, y, h)`` gets one series in order (``datetime64`` months and floats) and
the number of steps; it returns ``h`` forecasts with lower and upper bounds, three arrays
of that length. It runs inside tasks on a few dozen months at a time; Spark groups the
series, so it needs no Spark itself.

Every series gives ``h`` rows. One whose model raises, or returns another shape, gives
them with NULL forecasts and the reason in ``failure``, and the job goes on.

Defined cases: rows without ``ds`` are left out; a series with NULL values gets them as
NaN; NULL keys are keys like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.operators.forecast import future_dates, params_z
from fieldnotes.params import Params

FitPredict = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def map_models(series: DataFrame, fit_predict: FitPredict, params: Params, keys: tuple[str, ...] = ("unique_id",)) -> DataFrame:
    """(keys, ds, y_hat, y_hat_lo, y_hat_hi, failure) for the ``h`` months after each series."""
    keys, h = list(keys), params.h
    rows = series.where("ds IS NOT NULL").select(*[F.col(k).cast("string").alias(k) for k in keys], "ds", F.col("y").cast("double").alias("y"))
    schema = ", ".join([*(f"{k} string" for k in keys), "last_ds timestamp_ntz", "k int", "y_hat double", "y_hat_lo double", "y_hat_hi double", "failure string"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ds")
        failure = None
        try:
            found = [np.asarray(x, float) for x in fit_predict(group["ds"].to_numpy(), group["y"].to_numpy(), h)]
            if [x.shape for x in found] != [(h,)] * 3:
                raise ValueError(f"not three arrays of {h} values")
        except Exception as e:  # noqa: BLE001  the series' own result
            found, failure = [np.full(h, np.nan)] * 3, f"{type(e).__name__}: {e}"
        out = {k: [group[k].iloc[0]] * h for k in keys}
        out |= {"last_ds": [group["ds"].iloc[-1]] * h, "k": range(1, h + 1)}
        out |= {n: [None if np.isnan(v) else v for v in x] for n, x in zip(("y_hat", "y_hat_lo", "y_hat_hi"), found)}
        return pd.DataFrame(out | {"failure": [failure] * h})

    done = rows.groupBy(*keys).applyInPandas(run, schema)
    return done.select(*keys, future_dates(F.col("last_ds"), F.col("k")).alias("ds"), "y_hat", "y_hat_lo", "y_hat_hi", "failure")


def as_fit(fit_predict: FitPredict) -> Callable[..., DataFrame]:
    """``fit_predict`` as a model of ``forecast.forecast_all``; series that failed have NULL forecasts there."""
    return lambda series, params, keys: map_models(series, fit_predict, params, keys).drop("failure")


def seasonal_repeat(season: int, level: int = 90) -> FitPredict:
    """The last season again, bounds by the root mean square of the changes from season to season."""
    z = params_z(level)

    def fit_predict(ds: np.ndarray, y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(y) < season:
            raise ValueError("shorter than a season")
        change = y[season:] - y[:-season]
        spread = np.sqrt((change * change).sum() / len(change)) if len(change) else np.nan
        point = y[len(y) - season + np.arange(h) % season]
        return point, point - z * spread, point + z * spread

    return fit_predict
