"""Vectorised tail probabilities that Spark has no built-in for."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 400) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300

    def guard(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, steps + 1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / guard(1.0 + even * d)
        c = guard(1.0 + even / c)
        h = h * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / guard(1.0 + odd * d)
        c = guard(1.0 + odd / c)
        change = d * c
        h = h * change
        if np.all(np.abs(change - 1.0) < 1e-15):
            break
    return h


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    inside = np.clip(x, 1e-300, 1.0 - 1e-16)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(inside) + b * np.log1p(-inside))
    low = inside < (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(low, a, b), np.where(low, b, a), np.where(low, inside, 1.0 - inside)
    part = front * _beta_fraction(aa, bb, xx) / aa
    value = np.where(low, part, 1.0 - part)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, value))


def rank_correlation_p(rho: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p of a correlation from Student's t with n - 2 degrees of freedom."""
    rho, n = np.asarray(rho, dtype=float), np.asarray(n, dtype=float)
    rest = 1.0 - rho * rho
    p = incomplete_beta(np.maximum(n - 2.0, 1.0) / 2.0, np.full_like(rho, 0.5), rest)
    p = np.where(rest <= 0, 0.0, p)
    return np.where(np.isnan(rho) | (n < 3), np.nan, p)


def hypergeometric_upper(k: np.ndarray, universe: np.ndarray, members: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """P(X >= k) when ``drawn`` of ``universe`` items are taken and ``members`` are marked.

    Log factorials are one prefix table, in extended precision as its last entries are large; the
    terms of all rows lie side by side and are summed by row.
    """
    k, universe, members, drawn = (np.asarray(x, dtype=np.int64) for x in (k, universe, members, drawn))
    least = np.maximum(0, drawn + members - universe)
    low, high = np.maximum(k, least), np.minimum(members, drawn)
    out = np.where(k <= least, 1.0, 0.0)
    rows = np.flatnonzero((k > least) & (low <= high))
    if not len(rows):
        return out
    table = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, int(universe[rows].max()) + 1, dtype=np.longdouble)))))

    def choose(top, bottom):
        return table[top] - table[bottom] - table[top - bottom]

    sizes = high[rows] - low[rows] + 1
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(rows, sizes)
    x = np.arange(int(sizes.sum())) - np.repeat(starts, sizes) + low[row]
    logs = choose(members[row], x) + choose(universe[row] - members[row], drawn[row] - x) - choose(universe[row], drawn[row])
    out[rows] = np.minimum(1.0, np.add.reduceat(np.exp(logs), starts).astype(float))
    return out


@F.pandas_udf(DoubleType())
def rank_correlation_p_udf(rho: pd.Series, n: pd.Series) -> pd.Series:
    values = pd.Series(rank_correlation_p(rho.to_numpy(dtype=float), n.to_numpy(dtype=float)))
    return values.where(values.notna(), None)


@F.pandas_udf(DoubleType())
def hypergeometric_upper_udf(k: pd.Series, universe: pd.Series, members: pd.Series, drawn: pd.Series) -> pd.Series:
    return pd.Series(hypergeometric_upper(k.to_numpy(), universe.to_numpy(), members.to_numpy(), drawn.to_numpy()))
