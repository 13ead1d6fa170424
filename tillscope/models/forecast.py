"""Autoregressive forecasts of many daily series in one plan.

ARIMA(7,1,0) by exact Gaussian likelihood. After its first seven steps the Kalman filter of
an autoregression predicts by the coefficients alone, so all later steps enter the likelihood
through sums of products. These are one distributed aggregation; per series only an 8 x 8 table
and the first seven differences reach Python, where the filter runs over those seven and
the likelihood is maximised. Its cost does not depend on the length of a series.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.sources.lake import with_audit

# The functions below run on executors, where this package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAGS = 7
HORIZON = 30
SHORTEST = 14
Z95 = 1.959964
RIDGE = 1e-12  # of the sum of squares; keeps the logarithm finite for a series that is predicted exactly
STEPS = 100
_FLAT = 18.0  # partial autocorrelations are tanh of something between - and + this

FORECAST_SCHEMA = (
    "metric_name string, is_count boolean, forecast_date date, forecast_value double, lower_bound double, upper_bound double"
)


def daily_series(tx: DataFrame, by: str | None = None) -> DataFrame:
    """(metric_name, date, y, is_count): transactions and Success revenue per day, per value of ``by``."""
    keys = [by] if by else []
    days = tx.groupBy(*keys, F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("transactions"),
        c.or_zero(c.sum_where(c.success(), "amount").cast("double")).alias("revenue"),
    )
    long = days.unpivot([*keys, "date"], ["transactions", "revenue"], "metric", "y")
    name = F.concat_ws(":", "metric", by) if by else F.col("metric")
    return long.select(name.alias("metric_name"), "date", "y", (F.col("metric") == "transactions").alias("is_count"))


def densify(series: DataFrame) -> DataFrame:
    """Days without a row between a series' first and last day get 0."""
    span = series.groupBy("metric_name", "is_count").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select("metric_name", "is_count", F.explode(F.sequence("a", "b")).alias("date"))
    return days.join(series.drop("is_count"), ["metric_name", "date"], "left").fillna(0.0, ["y"])


def lagged_differences(series: DataFrame, lags: int = LAGS) -> DataFrame:
    """(metric_name, date, y, n, d0 .. d<lags>): first difference and its lags.

    Rows count as consecutive whatever their dates. A series has one row per
    day, so its window is bounded by the calendar.
    """
    order = Window.partitionBy("metric_name").orderBy("date")
    diff = series.withColumn("d0", F.col("y") - F.lag("y").over(order)).withColumn(
        "n", F.row_number().over(order)
    )
    return diff.withColumns({f"d{i}": F.lag("d0", i).over(order) for i in range(1, lags + 1)})


def gram(lagged: DataFrame, lags: int = LAGS) -> DataFrame:
    """One row per series: sums of products g_i_j over the rows with all lags, the first
    ``lags`` differences (latest first), the last values, and the number of days."""
    names = [f"d{i}" for i in range(lags + 1)]
    full = F.col(f"d{lags}").isNotNull()
    sums = [
        F.coalesce(F.sum(F.when(full, F.col(a) * F.col(b))), F.lit(0.0)).alias(f"g_{i}_{j}")
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if i <= j
    ]
    last = F.max_by(F.struct("date", "y", *names[:-1]), "n")
    first = F.max(F.when(F.col("n") == lags + 1, F.struct(*names[:-1])))
    sums_and_last = lagged.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.count_if(full).alias("n_obs"), F.max("is_count").alias("is_count"),
        last.alias("last"), first.alias("first"), *sums
    )
    flat = [F.col(f"last.{x}").alias(f"last_{x}") for x in ("date", "y", *names[:-1])]
    flat += [F.col(f"first.{x}").alias(f"first_{x}") for x in names[:-1]]
    return sums_and_last.select("*", *flat).drop("last", "first")


def gram_ratios(grams: DataFrame, lags: int = LAGS) -> DataFrame:
    """Long form (metric_name, n_days, n_obs, entry, ratio): each sum over that of d0 * d0."""
    entries = [f"g_{i}_{j}" for i in range(lags + 1) for j in range(i, lags + 1)]
    long = grams.select("metric_name", "n_days", "n_obs", F.col("g_0_0").alias("base"), *entries).unpivot(
        ["metric_name", "n_days", "n_obs", "base"], entries, "entry", "g"
    )
    return long.select(
        "metric_name", "n_days", "n_obs", "entry",
        F.round(F.try_divide(F.col("g"), F.col("base")), 6).alias("ratio"),
    )


def _filtered(z: np.ndarray, start: np.ndarray):
    """Coefficients, and the filter's squared errors and log variances over the first differences.

    ``z`` are the inverse hyperbolic tangents of the partial autocorrelations: any values
    give a stationary process. Variances are relative to that of the shocks.
    """
    phi, scale = np.zeros(0, z.dtype), 1.0
    share = np.tanh(z)
    for k in share:
        scale = scale / (1 - k * k)
    squares = log_scale = 0.0
    for t, k in enumerate(share):
        error = start[t] - (phi @ start[:t][::-1] if t else 0.0)
        squares, log_scale = squares + error * error / scale, log_scale + np.log(scale)
        scale = scale * (1 - k * k)
        phi = np.append(phi - k * phi[::-1], k)
    return phi, squares, log_scale


def _objective(z: np.ndarray, g: np.ndarray, start: np.ndarray, n: int):
    """-2 log likelihood with the best variance of shocks, but for constants."""
    phi, squares, log_scale = _filtered(z, start)
    squares = squares + g[0, 0] - 2 * phi @ g[1:, 0] + phi @ g[1:, 1:] @ phi
    return n * np.log(squares + RIDGE * (g[0, 0] + start @ start)) + log_scale


def _gradient(z: np.ndarray, *data) -> np.ndarray:
    """By steps along the imaginary axis, exact to rounding."""
    steps = z + 1e-30j * np.eye(len(z))
    return np.array([_objective(s, *data).imag for s in steps]) / 1e-30


def fit(g: np.ndarray, start: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Coefficients and standard deviation of shocks that maximise the exact likelihood.

    ``g`` are the sums of products of the differences and their lags from difference
    ``len(start)`` on, ``start`` the differences before, ``n`` the number of all. Newton's
    method, by the gradient where the second derivatives do not point down.
    """
    lags = len(start)
    if not g[0, 0] + start @ start:
        return np.zeros(lags), 0.0
    data = (g, start, n)
    z, value = np.zeros(lags), _objective(np.zeros(lags), *data)
    for _ in range(STEPS):
        slope = _gradient(z, *data)
        if np.abs(slope).max() < 1e-11 * n:
            break
        wide = 1e-5
        bend = np.array([(_gradient(z + d, *data) - _gradient(z - d, *data)) / (2 * wide) for d in wide * np.eye(lags)])
        bend = (bend + bend.T) / 2
        roots, axes = np.linalg.eigh(bend)
        step = -axes @ ((axes.T @ slope) / np.maximum(np.abs(roots), 1e-6 * n))
        share = 1.0
        while share > 1e-12:
            there = np.clip(z + share * step, -_FLAT, _FLAT)
            after = _objective(there, *data)
            if after < value:
                break
            share /= 2
        else:
            break
        z, value = there, after
    phi, squares, _ = _filtered(z, start)
    squares += g[0, 0] - 2 * phi @ g[1:, 0] + phi @ g[1:, 1:] @ phi
    return phi, float(np.sqrt(max(squares, 0.0) / n))


def _forecast_one(row: pd.Series, lags: int, horizon: int) -> pd.DataFrame:
    g = np.array([[row[f"g_{min(i, j)}_{max(i, j)}"] for j in range(lags + 1)] for i in range(lags + 1)])
    start = np.array([row[f"first_d{i}"] for i in range(lags)], float)[::-1]
    phi, sigma = fit(g, start, int(row["n_days"]) - 1)

    recent = [row[f"last_d{i}"] for i in range(lags)]
    recent = [0.0 if pd.isna(v) else v for v in recent]
    level, values = row["last_y"], []
    for _ in range(horizon):
        step = float(phi @ np.array(recent[:lags]))
        recent.insert(0, step)
        level += step
        values.append(level)

    # Weights of past shocks in the level: cumulative sums of those in the difference.
    psi = [1.0]
    for h in range(1, horizon):
        psi.append(sum(phi[i] * psi[h - 1 - i] for i in range(min(lags, h))))
    spread = Z95 * sigma * np.sqrt(np.cumsum(np.cumsum(psi) ** 2))
    first = pd.Timestamp(row["last_date"])
    days = [first + pd.Timedelta(days=h + 1) for h in range(horizon)]
    values = np.array(values)
    return pd.DataFrame(
        {
            "metric_name": row["metric_name"],
            "is_count": row["is_count"],
            "forecast_date": [d.date() for d in days],
            "forecast_value": values,
            "lower_bound": values - spread,
            "upper_bound": values + spread,
        }
    )


def forecast(series: DataFrame, lags: int = LAGS, horizon: int = HORIZON) -> DataFrame:
    """The next ``horizon`` days per series with 95 % bounds, cut at 0; where ``is_count`` holds they are whole.

    Series shorter than 14 days give no rows.
    """
    grams = gram(lagged_differences(series, lags), lags).where(F.col("n_days") >= SHORTEST)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_forecast_one(row, lags, horizon) for _, row in pdf.iterrows()])

    raw = grams.groupBy("metric_name").applyInPandas(solve, FORECAST_SCHEMA)

    def shaped(name: str):
        cut = F.greatest(F.col(name), F.lit(0.0))
        return F.when(F.col("is_count"), F.bround(cut, 0)).otherwise(cut)

    values = ("forecast_value", "lower_bound", "upper_bound")
    made = raw.withColumns({name: shaped(name) for name in values}).drop("is_count")
    return with_audit(made, model_name="arima")
