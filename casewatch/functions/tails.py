"""Tail probabilities that Spark SQL has no function for.

Applied to result rows of tests, never to cases. The incomplete beta function is summed as
its continued fraction (modified Lentz), for a whole column at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300


_SHIFT = 12  # the asymptotic series of the log-gamma function is used from here on
_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)  # its terms in 1/z, 1/z**3, ...


def _log_gamma_step(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log gamma(a + b) - log gamma(a), to full digits also where both are large.

    The argument is shifted up, where the difference of the asymptotic series needs no large numbers.
    """
    z = a + _SHIFT
    ratio = np.log1p(b / z)
    step = b * np.log(z) + (z + b - 0.5) * ratio - b
    for i, c in enumerate(_SERIES):
        step += c * ((z + b) ** -(2 * i + 1) - z ** -(2 * i + 1))
    for i in range(_SHIFT):
        step -= np.log1p(b / (a + i))
    return step


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function; it needs about sqrt(max(a, b)) terms."""
    rounds = 200 + int(20 * np.sqrt(np.nanmax(np.maximum(a, b), initial=1.0)))
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    total = d.copy()
    for m in range(1, rounds):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1.0 + term / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            step = c * d
            total = total * step
        # With millions of degrees of freedom, rounding keeps the factor further from 1 than the terms that are left.
        if np.nanmax(np.abs(step - 1.0), initial=0.0) < (1e-15 if m < 1000 else 1e-13):
            return total
    raise ArithmeticError("the continued fraction of the incomplete beta function did not converge")


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, rest: np.ndarray | None = None) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b); ``rest`` is 1 - x where that is known to more digits."""
    rest = 1.0 - np.asarray(x, dtype=float) if rest is None else rest
    a, b, x, rest = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x, rest))
    swap = x > (a + 1.0) / (a + b + 2.0)
    aa, bb, xx, yy = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, rest, x), np.where(swap, x, rest)
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    large, small = np.maximum(aa, bb), np.minimum(aa, bb)
    with np.errstate(divide="ignore", invalid="ignore"):
        log_x = np.where(xx > 0.5, np.log1p(-yy), np.log(xx))
        log_y = np.where(xx > 0.5, np.log(yy), np.log1p(-xx))
        front = np.exp(_log_gamma_step(large, small) - log_gamma(small) + aa * log_x + bb * log_y) / aa
        value = np.where(xx <= 0.0, 0.0, front * _beta_fraction(aa, bb, xx))
        value = np.where(swap, 1.0 - value, value)
        # Close to 1, x has lost the digits that its rest still has: there the other tail is summed from the rest.
        near = (rest < 1e-3) & (rest > 0.0) & (a * rest < 300.0)
        if near.any():
            value = np.where(near, 1.0 - _other_tail(np.where(near, a, 1.0), np.where(near, b, 1.0), np.where(near, rest, 0.5)), value)
    return value


def _other_tail(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """I_y(b, a) by its series of positive terms."""
    term, total, n = np.ones_like(y), np.ones_like(y), 0
    while np.nanmax(term / total, initial=0.0) > 1e-17:
        term = term * (a + b + n) / (b + 1 + n) * y
        total = total + term
        n += 1
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    large, small = np.maximum(a, b), np.minimum(a, b)
    return total * np.exp(_log_gamma_step(large, small) - log_gamma(small) + b * np.log(y) + a * np.log1p(-y)) / b


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| > |z|)."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), na_action="ignore")


def _where_known(frame: pd.DataFrame, value) -> pd.Series:
    """``value`` of the rows without a missing argument, NaN elsewhere."""
    known = frame.notna().all(axis=1)
    out = pd.Series(np.nan, index=frame.index)
    if known.any():
        out[known] = value(*(frame.loc[known, c].to_numpy(float) for c in frame.columns))
    return out


@F.pandas_udf(DoubleType())
def t_two_sided(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """P(|T| > |t|) with df degrees of freedom."""
    for t, df in batches:
        frame = pd.concat([t, df], axis=1, keys=["t", "df"])
        yield _where_known(frame, lambda x, n: incomplete_beta(n / 2.0, np.full_like(n, 0.5), n / (n + x * x), x * x / (n + x * x)))


@F.pandas_udf(DoubleType())
def f_upper(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """P(F > f) with (d1, d2) degrees of freedom."""
    for f, d1, d2 in batches:
        frame = pd.concat([f, d1, d2], axis=1, keys=["f", "d1", "d2"])
        yield _where_known(frame, lambda x, n, m: incomplete_beta(m / 2.0, n / 2.0, m / (m + n * x), n * x / (m + n * x)))
