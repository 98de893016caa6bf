"""Small per-series numeric helpers for the augmented Dickey-Fuller test.

Spark computes the regression sums; these functions only turn one series'
sums (a few hundred numbers) into a lag choice, a t-ratio and a p-value.
Regression with a constant; lag by AIC; p-value from MacKinnon's (1994)
response-surface approximation for one variable with a constant.
"""

from __future__ import annotations

import math

import numpy as np

# MacKinnon (1994) approximate asymptotic p-value surface,
# "constant" case, one variable. Beyond the max/min statistic p is 1/0; the
# small-p polynomial applies at or below the star statistic.
TAU_MAX = 2.74
TAU_MIN = -18.83
TAU_STAR = -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def maxlag_for(n: int) -> int:
    """Upper lag bound used by the AIC search: min(n//2 - 2, ceil(12 (n/100)^(1/4)))."""
    return min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def mackinnon_p(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    coef = SMALL_P if tau <= TAU_STAR else LARGE_P
    return norm_cdf(sum(c * tau**i for i, c in enumerate(coef)))


#: A regressor is dependent on those before it if its pivot falls below this share of its own square.
PIVOT = 1e-10


def cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor of a matrix of unit diagonal, and which columns are independent; a dependent column's are zero."""
    m = len(a)
    low, free = np.zeros((m, m)), np.zeros(m, bool)
    for j in range(m):
        d = a[j, j] - low[j, :j] @ low[j, :j]
        if d > PIVOT:
            free[j] = True
            low[j, j] = math.sqrt(d)
            low[j + 1 :, j] = (a[j + 1 :, j] - low[j + 1 :, :j] @ low[j, :j]) / low[j, j]
    return low, free


def _scaled(a: np.ndarray, xty: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """X'X of unit diagonal, X'y to go with it, and the columns' norms."""
    norm = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    return a / norm[:, None] / norm[None, :], xty / norm, norm


def _forward(low: np.ndarray, free: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solution of low w = rhs, zero at dependent columns."""
    w = np.zeros(len(rhs))
    for j in np.flatnonzero(free):
        w[j] = (rhs[j] - low[j, :j] @ w[:j]) / low[j, j]
    return w


def choose_lag(a: np.ndarray, xty: np.ndarray, yty: float, nobs: float, maxlag: int) -> int:
    """Lag with the smallest AIC on the common sample; ties go to the shorter lag.

    Columns of ``a``: constant, lagged level, lagged differences 1..L. One factor holds every leading sub-model:
    the residual sum at lag p is what the first p + 2 components of the forward solution leave of y'y.
    """
    m = maxlag + 2
    unit, rhs, _ = _scaled(a[:m, :m], xty[:m])
    low, free = cholesky(unit)
    explained, rank = np.cumsum(_forward(low, free, rhs) ** 2), np.cumsum(free)
    best, best_p = math.inf, 0
    for p in range(maxlag + 1):
        v = aic(max(yty - explained[p + 1], 0.0), nobs, int(rank[p + 1]))
        if v < best:
            best, best_p = v, p
    return best_p


def aic(ssr: float, nobs: float, rank: int) -> float:
    if ssr <= 0.0:
        return -math.inf
    return nobs * (math.log(2.0 * math.pi) + math.log(ssr / nobs) + 1.0) + 2.0 * rank


def tau_stat(a: np.ndarray, xty: np.ndarray, yty: float, nobs: float, p: int) -> float | None:
    """t-ratio of the lagged level at lag ``p`` (its own sample); None if the level is dependent on the rest.

    With the level as last column its coefficient over its standard error is the last component of the forward
    solution over the residual's deviation.
    """
    order = [0, *range(2, p + 2), 1]
    unit, rhs, _ = _scaled(a[np.ix_(order, order)], xty[order])
    low, free = cholesky(unit)
    w = _forward(low, free, rhs)
    ssr, dof = yty - float(w @ w), nobs - int(free.sum())
    if dof <= 0 or ssr <= 0.0 or not free[-1]:
        return None
    return float(w[-1] / math.sqrt(ssr / dof))


def sums_of(x: np.ndarray, dx: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and count of the rows (lagged level, difference, lagged differences)."""
    xm = np.column_stack([np.ones(len(x)), x, lags]) if len(x) else np.zeros((0, 2 + lags.shape[1]))
    return xm.T @ xm, xm.T @ dx, float(dx @ dx), len(x)


def own_sample(sums: tuple, head: np.ndarray, lag: int, maxlag: int) -> tuple:
    """The sums of the sample that starts at ``lag``: those of the common sample, which starts at ``maxlag``, and the rows between.

    ``head`` holds the series' first ``maxlag + 2`` values, which the rows between are made of.
    """
    a, b, c, n = sums
    m = lag + 2
    d = np.diff(head)
    rows = range(lag, min(maxlag, len(d)))
    lags = np.array([[d[t - j] for j in range(1, lag + 1)] for t in rows]).reshape(len(rows), lag)
    a2, b2, c2, n2 = sums_of(np.array([head[t] for t in rows]), np.array([d[t] for t in rows]), lags)
    return a[:m, :m] + a2, b[:m] + b2, c + c2, n + n2
