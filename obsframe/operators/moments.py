"""Co-moments of complete rows, from one native aggregation, and the fits that need nothing else.

Counts, means and co-moments of k columns are k(k+3)/2 numbers per group, merged across tasks (map-side partials, Welford updates,
so a large offset does not cancel). Only these reach the driver. Linear fits, their cross-validation errors and principal
components follow from them without another pass over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import col_ref, nan_to_null


class Moments(NamedTuple):
    """Number of rows, means, and sums of products of deviations from the means."""

    n: int
    mean: np.ndarray
    comoment: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        step = other.mean - self.mean
        return Moments(n, self.mean + step * other.n / n, self.comoment + other.comoment + np.outer(step, step) * self.n * other.n / n)


def complete(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``columns`` as doubles beside ``keep``, without rows that miss one (NULL or NaN)."""
    return nan_to_null(df.select(*[col_ref(k) for k in keep], *[col_ref(c).cast("double").alias(c) for c in columns])).dropna("any", subset=list(columns))


def comoments(df: DataFrame, columns: Sequence[str], by: str | None = None) -> dict:
    """``Moments`` per value of ``by`` (None: of all rows, under the key None); ``by`` must have few values."""
    k = len(columns)
    c = [col_ref(x) for x in columns]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.count(F.lit(1)).alias("n"), *(F.avg(x).alias(f"m{i}") for i, x in enumerate(c)), *(F.covar_pop(c[i], c[j]).alias(f"c{i}_{j}") for i, j in pairs)]
    out = {}
    for r in (df.groupBy(by) if by else df.groupBy()).agg(*aggs).collect():
        co = np.zeros((k, k))
        for i, j in pairs:
            co[i, j] = co[j, i] = (r[f"c{i}_{j}"] or 0.0) * r["n"]
        out[r[by] if by else None] = Moments(r["n"], np.array([r[f"m{i}"] or 0.0 for i in range(k)]), co)
    return out


def total(parts: Sequence[Moments], k: int) -> Moments:
    return reduce(Moments.__add__, parts, Moments(0, np.zeros(k), np.zeros((k, k))))


class Linear(NamedTuple):
    """A linear fit of the last column of ``Moments`` on the others."""

    beta: np.ndarray
    intercept: float

    def column(self, features: Sequence[str]) -> Column:
        return reduce(lambda a, b: a + b, (col_ref(f) * F.lit(float(x)) for f, x in zip(features, self.beta, strict=True)), F.lit(float(self.intercept)))

    def squared_error(self, m: Moments) -> float:
        """Sum of squared errors over the rows that ``m`` describes."""
        b = np.append(-self.beta, 1.0)
        return float(b @ m.comoment @ b + m.n * (b @ m.mean - self.intercept) ** 2)


def _scaled(m: Moments) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Standard deviations, correlations of the features, their covariances with the label in units of their deviations, and the label's deviation."""
    cov = m.comoment / m.n
    sd = np.sqrt(np.diag(cov))
    unit = np.where(sd > 0, sd, 1.0)[:-1]
    return sd[:-1], cov[:-1, :-1] / np.outer(unit, unit), cov[:-1, -1] / unit, float(sd[-1])


def _unscaled(m: Moments, sd: np.ndarray, gamma: np.ndarray) -> Linear:
    beta = np.where(sd > 0, gamma / np.where(sd > 0, sd, 1.0), 0.0)
    return Linear(beta, float(m.mean[-1] - beta @ m.mean[:-1]))


def ridge(m: Moments, penalty: float) -> Linear:
    """Least squares with ``penalty`` on standardised features and label (as Spark ML's ``regParam`` with elasticNetParam 0)."""
    sd, corr, c, label = _scaled(m)
    return _unscaled(m, sd, np.linalg.lstsq(corr + penalty / (label or 1.0) * np.eye(len(c)), c, rcond=None)[0])


def lasso(m: Moments, penalties: Sequence[float], tolerance: float = 1e-12, sweeps: int = 100_000) -> list[Linear]:
    """Fits minimising 1/(2n) squared error + penalty * sum |standardised coefficient|, one per penalty, by coordinate descent.

    Descent is warm-started from the largest penalty on and ends when no coefficient moves by ``tolerance`` of the label's deviation."""
    sd, corr, c, label = _scaled(m)
    gamma, out = np.zeros(len(c)), {}
    for p in sorted(set(penalties), reverse=True):
        for _ in range(sweeps):
            moved = 0.0
            for j in np.flatnonzero(sd > 0):
                r = c[j] - corr[j] @ gamma + corr[j, j] * gamma[j]
                new = math.copysign(max(abs(r) - p, 0.0), r) / corr[j, j]
                moved, gamma[j] = max(moved, abs(new - gamma[j])), new
            if moved <= tolerance * (label or 1.0):
                break
        out[p] = _unscaled(m, sd, gamma.copy())
    return [out[p] for p in penalties]


def principal_variances(m: Moments) -> np.ndarray:
    """Shares of the variance of the standardised columns, largest first (constant columns have none)."""
    sd = np.sqrt(np.diag(m.comoment))
    on = sd > 0
    if not on.any():
        return np.zeros(len(sd))
    w = np.linalg.eigvalsh(m.comoment[np.ix_(on, on)] / np.outer(sd[on], sd[on]))[::-1]
    return np.append(np.maximum(w, 0.0) / w.sum(), np.zeros(int((~on).sum())))


def beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function I_x(a, b), by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_tail(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or 1e-300)
    h = d
    for i in range(1, 10_000):
        for step in (i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i)), -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))):
            d, c = 1 / ((1 + step * d) or tiny), (1 + step / c) or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def student_p(t: float, freedom: float) -> float:
    """Two-sided p-value of a t statistic."""
    return beta_tail(freedom / (freedom + t * t), freedom / 2, 0.5) if math.isfinite(t) else 0.0 if math.isinf(t) else math.nan
