"""Aggregate-expression helpers that stay safe under Spark's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_corr(a, b) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant input or fewer than 2 pairs.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when one side is constant, and
    wrapping it in CASE does not help because the aggregate is still evaluated.
    Restrict both sides to complete pairs and divide with ``try_divide``.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    ax = F.when(both, a)
    bx = F.when(both, b)
    return F.try_divide(F.covar_samp(ax, bx), F.stddev_samp(ax) * F.stddev_samp(bx))


def corr_from_moments(n, sx, sy, sxx, syy, sxy) -> Column:
    """Correlation from summed moments of complete pairs; NULL when undefined."""
    num = n * sxy - sx * sy
    den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    return F.when((n >= 2) & (den > 0), num / den)


def strict_avg(value, cond=None) -> Column:
    """Mean that is NULL as soon as one input is NULL (R's ``mean`` without ``na.rm``)."""
    v = F.col(value) if isinstance(value, str) else value
    if cond is None:
        return F.when(F.count(F.lit(1)) == F.count(v), F.avg(v))
    return F.when(F.count_if(cond) == F.count(F.when(cond, v)), F.avg(F.when(cond, v)))
