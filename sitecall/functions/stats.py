"""Statistical Column functions.

Tail probabilities keep relative accuracy deep into the tails (unlike ``1 - cdf``). The chi-square tail is a series or
a continued fraction in Column arithmetic; the binomial tail is the continued fraction of the incomplete beta function
in NumPy over Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sitecall.functions.motif import col
from sitecall.options import BACKGROUND_FLOOR, EXPECTED_FLOOR


def _dbl(x) -> Column:
    return (F.lit(float(x)) if isinstance(x, (int, float)) else col(x)).cast("double")


def _with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


ERFC_TERMS = 40  # below 2 the series, above it the continued fraction is exact to double precision with fewer


def _erfc(z: Column) -> Column:
    """Complementary error function of z > 0: one minus the series of erf, or Laplace's continued fraction."""
    one, square = F.lit(1.0), z * z
    series, fraction = one, z
    for n in range(ERFC_TERMS, 0, -1):
        series = one + square * F.lit(2.0 / (2 * n + 1)) * series
        fraction = z + F.lit(n / 2.0) / fraction
    decay = F.exp(-square) / F.lit(math.sqrt(math.pi))
    return F.when(z < 2, one - F.lit(2.0) * z * decay * series).otherwise(decay / fraction)


def chi2_sf_1df(stat) -> Column:
    """P(chi2_1 >= stat) = erfc(sqrt(stat / 2))."""
    s = _dbl(stat)
    return F.when(s <= 0, F.lit(1.0)).otherwise(_with_value(F.sqrt(s / F.lit(2.0)), _erfc))


_TINY = 1e-300
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function, by Lentz's recurrence, until no element changes."""
    c, d = np.ones_like(x), 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return h


def incomplete_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b) for 0 < x < 1 and a, b > 0."""
    front = np.exp((_lgamma(a + b) - _lgamma(a) - _lgamma(b)).astype(float) + a * np.log(x) + b * np.log1p(-x))
    small = x < (a + 1.0) / (a + b + 2.0)  # else the fraction of the other tail converges, and is the smaller one
    y, p, q = np.where(small, x, 1.0 - x), np.where(small, a, b), np.where(small, b, a)
    part = front * _beta_fraction(y, p, q) / p
    return np.where(small, part, 1.0 - part)


def _upper_tail(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    """P(X >= k) row by row; null where k, n or p is null."""
    out = np.full(len(k), np.nan)
    known = (k.notna() & n.notna() & p.notna()).to_numpy()
    kk, nn, pp = (x.to_numpy(dtype=float, na_value=np.nan) for x in (k, n, p))
    with np.errstate(invalid="ignore"):
        out[known & ((kk <= 0) | (pp >= 1) & (kk <= nn))] = 1.0
        out[known & ((kk > nn) | (pp <= 0) & (kk > 0))] = 0.0
    todo = known & np.isnan(out)
    if todo.any():
        out[todo] = incomplete_beta(pp[todo], kk[todo], nn[todo] - kk[todo] + 1.0)
    return pd.Series(out).where(pd.Series(known), None)


def binom_upper_tail(k, n, p) -> Column:
    """P(X >= k) for X ~ Binomial(n, p), i.e. ``binom.sf(k, n, p, loc=1)``.

    1 for k <= 0, 0 for k > n, else the regularised incomplete beta I_p(k, n-k+1).
    """
    kk, nn = col(k).cast("bigint"), col(n).cast("bigint")
    return F.pandas_udf(_upper_tail, "double")(kk, nn, _dbl(p))


def group_pvalue(uncon, depth, p: float = 0.01) -> Column:
    """Replicate-group test: 1 when uncon <= 0 or depth <= 0, else P(X >= uncon)."""
    u, d = col(uncon), col(depth)
    return F.when((u <= 0) | (d <= 0), F.lit(1.0)).otherwise(binom_upper_tail(u, d, p))


def background_rate(a, b, gc) -> Column:
    """Unconverted background a * exp(b * gc)."""
    return _dbl(a) * F.exp(_dbl(b) * _dbl(gc))


def mod_level(c, d, e, x) -> Column:
    """Modification level c * exp(-d (x - e)^2)."""
    xx = _dbl(x)
    return _dbl(c) * F.exp(-_dbl(d) * (xx - _dbl(e)) * (xx - _dbl(e)))


def combined_level(a, b, c, d, e, x) -> Column:
    m = mod_level(c, d, e, x)
    return m + (F.lit(1.0) - m) * background_rate(a, b, x)


def chi2_stat(uncon, depth, background) -> Column:
    """1-df goodness-of-fit statistic of (uncon, depth - uncon) against the background.

    The background is floored to 1e-4 and expected counts to 1e-10.
    """
    u, d = _dbl(uncon), _dbl(depth)
    b = F.greatest(F.lit(BACKGROUND_FLOOR), _dbl(background))
    eu = d * b
    ec = d * (F.lit(1.0) - b)
    eu = F.when(eu <= 0, F.lit(EXPECTED_FLOOR)).otherwise(eu)
    ec = F.when(ec <= 0, F.lit(EXPECTED_FLOOR)).otherwise(ec)
    c = d - u
    return (u - eu) * (u - eu) / eu + (c - ec) * (c - ec) / ec


def call_gate(uncon, depth, background, min_depth: int = 10, min_ratio: float = 0.1) -> Column:
    """True where the chi-square test is run; false means p = 1.

    Null when the background is missing and the depth/ratio rules do not
    already reject the site (the test cannot be run: p stays null).
    """
    u, d = _dbl(uncon), _dbl(depth)
    r = F.when(d > 0, u / d).otherwise(F.lit(0.0))
    b = F.greatest(F.lit(BACKGROUND_FLOOR), _dbl(background))
    cheap_reject = (d <= min_depth) | (d == 0) | (r < min_ratio) | (r == 0)
    return (
        F.when(cheap_reject, F.lit(False))
        .when(col(background).isNull(), F.lit(None).cast("boolean"))
        .otherwise(r > b)
    )


def call_pvalue(uncon, depth, background, min_depth: int = 10, min_ratio: float = 0.1) -> Column:
    """Site p-value: chi-square tail where the gate passes, 1 where it fails, null if no background."""
    gate = call_gate(uncon, depth, background, min_depth, min_ratio)
    return (
        F.when(gate.isNull(), F.lit(None).cast("double"))
        .when(~gate, F.lit(1.0))
        .otherwise(chi2_sf_1df(chi2_stat(uncon, depth, background)))
    )
