"""Forecasts for any number of monthly series at once."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.fixed_values import FORECAST_STATUS

_STEPS = T.ArrayType(T.StructType([T.StructField(name, T.DoubleType()) for name in ("f", "lower", "upper")]))


def _by_series(series: DataFrame) -> DataFrame:
    """One row per series: its values in time order, last month, last value, mean change.

    A series has one entry per calendar month. A change from 0 is undefined and left out.
    """
    points = F.sort_array(F.collect_list(F.struct("month_end", "value")))
    return series.groupBy("series").agg(points.alias("p")).selectExpr(
        "series",
        "transform(p, x -> x.value) AS x",
        "element_at(p, -1).month_end AS last_month",
        "element_at(p, -1).value AS last_value",
        """coalesce(aggregate(
            filter(zip_with(slice(p, 2, size(p)), slice(p, 1, size(p) - 1), (b, a) -> try_divide(b.value, a.value) - 1), c -> c IS NOT NULL),
            named_struct('s', 0D, 'n', 0), (acc, c) -> named_struct('s', acc.s + c, 'n', acc.n + 1), acc -> try_divide(acc.s, acc.n)
        ), 0D) AS growth""",
    )


def _rows_of(ahead: DataFrame) -> DataFrame:
    """``series, last_month, steps ARRAY<STRUCT<f, lower, upper>>, status`` as forecast rows."""
    return ahead.select("series", "last_month", "status", F.posexplode("steps").alias("at", "s")).select(
        "series",
        F.last_day(F.add_months("last_month", F.col("at") + 1)).alias("forecast_date"),
        F.bround("s.f", 2).alias("forecast_value"),
        F.bround("s.lower", 2).alias("lower"),
        F.bround("s.upper", 2).alias("upper"),
        "status",
    )


def _compound(steps: int, band: float) -> Column:
    value = "last_value * pow(1 + growth, i)"
    return F.expr(
        f"transform(sequence(1, {int(steps)}), i -> named_struct('f', {value}, 'lower', {value} * {1 - band}D, 'upper', {value} * {1 + band}D))"
    )


def compound_growth_forecast(series: DataFrame, steps: int = 6, band: float = 0.15) -> DataFrame:
    """Last value grown by the mean monthly change, with a proportional band."""
    status = F.lit(FORECAST_STATUS["fallback"]).alias("status")
    return _rows_of(_by_series(series).select("series", "last_month", _compound(steps, band).alias("steps"), status))


# --- seasonal model ---------------------------------------------------------------------------


def _lag_polynomial(*factors: list[float]) -> np.ndarray:
    out = np.ones(1)
    for factor in factors:
        out = np.convolve(out, factor)
    return out


def _seasonal(coef: float, period: int, sign: float = -1.0) -> list[float]:
    return [1.0] + [0.0] * (period - 1) + [sign * coef]


def _residuals(params: np.ndarray, w: np.ndarray, period: int) -> np.ndarray:
    """One-step errors of (1 - a B)(1 - A B^s) w = (1 + m B) e, from zero starting errors."""
    a, m, big_a = params
    ar = _lag_polynomial([1.0, -a], _seasonal(big_a, period))
    start = len(ar) - 1
    u = np.convolve(w, ar)[start : len(w)]
    e = np.empty_like(u)
    previous = 0.0
    for i, value in enumerate(u):
        previous = value - m * previous
        e[i] = previous
    return e


def _fit(w: np.ndarray, period: int, rounds: int = 60) -> np.ndarray:
    """Conditional least squares by damped Gauss-Newton steps inside the stationary box."""
    params, damping = np.array([0.1, -0.1, -0.1]), 1e-2
    e = _residuals(params, w, period)
    for _ in range(rounds):
        slope = np.column_stack([(_residuals(params + h, w, period) - e) / 1e-6 for h in np.eye(3) * 1e-6])
        step = np.linalg.solve(slope.T @ slope + damping * np.eye(3), -slope.T @ e)
        trial = np.clip(params + step, -0.98, 0.98)
        e_trial = _residuals(trial, w, period)
        if e_trial @ e_trial < e @ e:
            done = np.abs(trial - params).max() < 1e-8
            params, e, damping = trial, e_trial, damping / 3
            if done:
                break
        else:
            damping *= 4
            if damping > 1e12:
                break
    return params


def _project(x: np.ndarray, steps: int, period: int, level: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and half-width of the band for the next ``steps`` values."""
    w = np.diff(x[period:] - x[:-period])
    a, m, big_a = _fit(w, period)
    e = _residuals(np.array([a, m, big_a]), w, period)
    sigma2 = float(e @ e) / max(len(e) - 3, 1)
    full = _lag_polynomial([1.0, -a], _seasonal(big_a, period), [1.0, -1.0], _seasonal(1.0, period))
    path, last_error = list(x), e[-1]
    for _ in range(steps):
        value = -sum(full[j] * path[-j] for j in range(1, len(full)))
        path.append(value + m * last_error)
        last_error = 0.0
    psi = np.zeros(steps)
    for i in range(steps):
        psi[i] = (1.0 if i == 0 else m if i == 1 else 0.0) - sum(full[j] * psi[i - j] for j in range(1, min(i, len(full) - 1) + 1))
    half = NormalDist().inv_cdf(0.5 + level / 2) * np.sqrt(sigma2 * np.cumsum(psi**2))
    return np.array(path[-steps:]), half


def seasonal_forecast(series: DataFrame, steps: int = 6, period: int = 12, level: float = 0.95, band: float = 0.15) -> DataFrame:
    """Seasonal ARIMA (1,1,1)x(1,1,0,period) forecast per series, floored at 0.

    A series is one row holding its months, and an Arrow-batched function fits batches of
    such rows, so thousands of series fit in parallel. Series on which the model fails,
    as on those without a month to compare, get the compound-growth forecast, computed on the same row.
    Estimation is conditional least squares, not exact likelihood.
    """
    def fitted(x: np.ndarray) -> list[dict] | None:
        try:
            mean, half = _project(x, steps, period, level)
        except (np.linalg.LinAlgError, FloatingPointError, ValueError, IndexError):  # IndexError: no month is left to fit
            return None
        if not (np.isfinite(mean).all() and np.isfinite(half).all()):
            return None
        return [
            {"f": max(m, 0.0), "lower": max(m - h, 0.0), "upper": max(m + h, 0.0)} for m, h in zip(mean.tolist(), half.tolist())
        ]

    @F.pandas_udf(_STEPS)
    def fit(xs: pd.Series) -> pd.Series:
        return xs.map(lambda x: fitted(np.asarray(x, dtype=float)))

    both = _by_series(series).withColumns({"fit": fit("x"), "compound": _compound(steps, band)})
    has_fit = F.col("fit").isNotNull()
    status = F.when(has_fit, FORECAST_STATUS["fitted"]).otherwise(FORECAST_STATUS["fallback"])
    return _rows_of(both.select("series", "last_month", F.coalesce("fit", "compound").alias("steps"), status.alias("status")))


def forecast_document(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """``series, document``: history and forecast of each series as one JSON text."""

    def ordered(date: str, *values: str):
        return F.sort_array(F.collect_list(F.struct(date, *values)))

    past = series.groupBy("series").agg(ordered("month_end", "value").alias("h"))
    ahead = forecast.groupBy("series").agg(
        F.first("status").alias("status"), ordered("forecast_date", "forecast_value", "lower", "upper").alias("f")
    )

    def column(array: str, field: str):
        return F.transform(array, lambda x: x[field])

    def dates(array: str, field: str):
        return F.transform(array, lambda x: F.date_format(x[field], "yyyy-MM-dd"))

    return past.join(ahead, "series").select(
        "series",
        F.to_json(
            F.struct(
                "status",
                dates("h", "month_end").alias("historical_dates"),
                column("h", "value").alias("historical_values"),
                dates("f", "forecast_date").alias("forecast_dates"),
                column("f", "forecast_value").alias("forecast_values"),
                column("f", "lower").alias("lower_confidence_interval"),
                column("f", "upper").alias("upper_confidence_interval"),
            )
        ).alias("document"),
    )
