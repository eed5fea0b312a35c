"""Tail probabilities that SQL lacks, for per-test results.

Upper incomplete gamma and incomplete beta by their textbook series and
continued fractions, as NumPy iterations over whole Arrow batches: every step
works on the values that have not converged. Large shapes take asymptotic forms, so
no series is ever cut off.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Workers get these few functions with the plan, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 1e-15
# Shapes beyond this take the uniform asymptotic expansion; below it the series converge in a few thousand steps.
_LARGE = 1e5

def _nonzero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < _TINY, _TINY, x)


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """log of Gamma(z) for z > 0: Stirling's series after raising z to at least 16."""
    z = np.asarray(z, float).copy()
    product = np.ones_like(z)
    for _ in range(16):
        low = z < 16
        product[low] *= z[low]
        z[low] += 1
    w = 1 / (z * z)
    series = (1 / 12 - w * (1 / 360 - w * (1 / 1260 - w * (1 / 1680 - w / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function: Q(1/2, x^2) on the right, its mirror image on the left."""
    x = np.asarray(x, float)
    right = gamma_upper(np.full(x.shape, 0.5), x * x)
    return np.where(x >= 0, right, 2 - right)


def _gamma_series(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    term = 1 / a
    total, k, active = term.copy(), a.copy(), np.arange(len(a))
    while len(active):
        k[active] += 1
        term[active] *= x[active] / k[active]
        total[active] += term[active]
        active = active[term[active] > total[active] * _EPS]
    return total


def _gamma_fraction(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    b = x + 1 - a
    c, d = np.full(len(a), 1 / _TINY), 1 / _nonzero(b)
    h, active, i = d.copy(), np.arange(len(a)), 0
    while len(active):
        i += 1
        an = -i * (i - a[active])
        b[active] += 2
        d[active] = 1 / _nonzero(an * d[active] + b[active])
        c[active] = _nonzero(b[active] + an / c[active])
        step = d[active] * c[active]
        h[active] *= step
        active = active[np.abs(step - 1) > 4 * _EPS]
    return h


def _gamma_asymptotic(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Temme's expansion of Q(a, x) for large ``a``, with its first corrections."""
    mu = x / a - 1
    # eta**2 / 2 = mu - log(1 + mu); near 0 by its power series.
    small = np.abs(mu) < 1e-3
    near = mu * (1 - mu / 3 + 7 * mu**2 / 36 - 73 * mu**3 / 540)
    far = np.sign(mu) * np.sqrt(np.maximum(0, 2 * (mu - np.log1p(np.maximum(mu, -1 + 1e-16)))))
    eta = np.where(small, near, far)
    safe = np.where(small, 1.0, eta)
    c0 = np.where(small, -1 / 3 + eta / 12 - 2 * eta**2 / 135, 1 / np.where(small, 1.0, mu) - 1 / safe)
    c1 = -1 / 540 - eta / 288
    lead = 0.5 * _erfc(eta * np.sqrt(a / 2))
    with np.errstate(under="ignore"):
        return np.clip(lead + np.exp(-a * eta**2 / 2) / np.sqrt(2 * np.pi * a) * (c0 + np.where(small, c1, 0) / a), 0, 1)


def gamma_upper(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma Q(a, x)."""
    out = np.ones(len(a))
    large = (x > 0) & (a > _LARGE)
    if large.any():
        out[large] = _gamma_asymptotic(a[large], x[large])
    rest = (x > 0) & ~large
    scale = np.zeros(len(a))
    with np.errstate(under="ignore"):
        scale[rest] = np.exp(-x[rest] + a[rest] * np.log(x[rest]) - _log_gamma(a[rest]))
    low = rest & (x < a + 1)
    out[low] = 1 - _gamma_series(a[low], x[low]) * scale[low]
    high = rest & ~low
    out[high] = scale[high] * _gamma_fraction(a[high], x[high])
    return out


def _log_half_ratio(a: np.ndarray) -> np.ndarray:
    """log of Gamma(a + 1/2) / Gamma(a), also for large ``a``."""
    plain = np.minimum(a, 1e4)
    return np.where(
        a < 1e4, _log_gamma(plain + 0.5) - _log_gamma(plain),
        0.5 * np.log(a) + np.log1p(-1 / (8 * a) + 1 / (128 * a * a)),
    )


def _beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c, d = np.ones(len(x)), 1 / _nonzero(1 - (a + b) * x / (a + 1))
    h, active, m = d.copy(), np.arange(len(x)), 0
    while len(active):
        m += 1
        p, q, z = a[active], b[active], x[active]
        for numerator in (
            m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d[active] = 1 / _nonzero(1 + numerator * d[active])
            c[active] = _nonzero(1 + numerator / c[active])
            step = d[active] * c[active]
            h[active] *= step
        active = active[np.abs(step - 1) > 4 * _EPS]
    return h


def chi2_tails(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(chi-square with ``df`` degrees of freedom exceeds ``x``), element by element."""
    x, df = np.maximum(np.asarray(x, float), 0), np.asarray(df, float)
    out = np.empty(len(x))
    one, two = df == 1, df == 2
    out[one] = _erfc(np.sqrt(x[one] / 2))
    out[two] = np.exp(-x[two] / 2)
    rest = ~(one | two)
    out[rest] = gamma_upper(df[rest] / 2, x[rest] / 2)
    return out


def t_tails(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|Student t with ``df`` degrees of freedom| exceeds |t|), element by element.

    This is I_x(df/2, 1/2) at x = df / (df + t^2), in logarithms so that neither
    large ``df`` nor small ``t`` loses digits. Beyond 1e7 the normal
    approximation with its first correction is exact to double precision.
    """
    t, df = np.abs(np.asarray(t, float)), np.asarray(df, float)
    out = np.ones(len(t))
    normal = (t > 0) & (df > 1e7)
    z = t[normal] * (1 - 1 / (4 * df[normal])) / np.sqrt(1 + t[normal] ** 2 / (2 * df[normal]))
    out[normal] = _erfc(z / math.sqrt(2))
    rest = (t > 0) & ~normal
    a, ratio = df[rest] / 2, t[rest] ** 2 / df[rest]
    x, y = 1 / (1 + ratio), ratio / (1 + ratio)
    log_x, log_y = -np.log1p(ratio), np.log(ratio) - np.log1p(ratio)
    with np.errstate(under="ignore"):
        front = np.exp(_log_half_ratio(a) - math.lgamma(0.5) + a * log_x + 0.5 * log_y)
    half = np.full(len(a), 0.5)
    direct = x <= (a + 1) / (a + 2.5)
    part = np.empty(len(a))
    part[direct] = front[direct] * _beta_fraction(x[direct], a[direct], half[direct]) / a[direct]
    part[~direct] = 1 - front[~direct] * _beta_fraction(y[~direct], half[~direct], a[~direct]) / 0.5
    out[rest] = part
    return out


def chi2_tail(x: float, df: float) -> float:
    """One value of ``chi2_tails``."""
    return float(chi2_tails(np.array([x]), np.array([df]))[0])


def t_tail(t: float, df: float) -> float:
    """One value of ``t_tails``."""
    return float(t_tails(np.array([t]), np.array([df]))[0])


def _vector(tails):
    def over(stat: pd.Series, df: pd.Series) -> pd.Series:
        out = np.full(len(stat), np.nan)
        known = (stat.notna() & df.notna() & (df > 0)).to_numpy()
        out[known] = tails(stat[known].to_numpy(float), df[known].to_numpy(float))
        return pd.Series(out).where(known, None)

    over.__annotations__ = {"stat": pd.Series, "df": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, DoubleType())


chi2_p = _vector(chi2_tails)
t_p = _vector(t_tails)
