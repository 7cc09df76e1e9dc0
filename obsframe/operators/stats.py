"""Correlation, regression and fit metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import col_ref, nan_to_null
from obsframe.functions.stats import corr_from_moments, guarded_corr
from obsframe.operators import moments
from obsframe.operators.joins import bounded_broadcast
from obsframe.operators.reshape import pivot, pivot_values

_MOMENTS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("i", "j")] +
                        [T.StructField(n, T.DoubleType()) for n in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def _gram_partials(k: int, centre: list[float]):
    """Per Arrow batch: pairwise-complete moment sums, about ``centre``, for every column pair i < j."""
    iu, ju = np.triu_indices(k, 1)
    centre = np.array(centre)

    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan) - centre
            m = (~np.isnan(x)).astype("float64")
            x0 = np.nan_to_num(x, nan=0.0)
            part = (m.T @ m, x0.T @ m, (x0 * x0).T @ m, x0.T @ x0)
            acc = part if acc is None else tuple(a + b for a, b in zip(acc, part))
        if acc is None:
            return
        n, s, q, p = acc
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "n": n[iu, ju],
                            "sx": s[iu, ju], "sy": s[ju, iu], "sxx": q[iu, ju], "syy": q[ju, iu],
                            "sxy": p[iu, ju]})
    return run


def corr_matrix(long: DataFrame, row_key: str | Sequence[str], code: str = "code", value: str = "value",
                codes: Sequence[str] | None = None, max_codes: int = 500) -> DataFrame:
    """Pairwise-complete Pearson correlation of every code pair (code_a < code_b).

    Observations are aligned on ``row_key`` (e.g. year). Plan: pivot to one row per
    key (one shuffle), per-partition Gram partials (numpy matrix products over an
    Arrow batch, k x k per task), then a grouped sum per pair. Work is O(rows * k^2)
    with no pair rows materialised per observation and no self-join. Moments are taken
    about each code's mean, so a large common offset does not cancel them; NaN is missing.
    """
    long = nan_to_null(long)
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    if codes is None:
        # one row per (row key, code), materialised once for the code list and the pivot
        from obsframe.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(long.sparkSession)
        long = long.groupBy(*keys, code).agg(F.avg(value).alias(value)).checkpoint(eager=True)
        codes = pivot_values(long, code, max_codes)
    codes = sorted(codes)
    k = len(codes)
    spark = long.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "idx int, code string")
    if k < 2:
        return names.limit(0).select(F.col("code").alias("code_a"), F.col("code").alias("code_b"),
                                     F.lit(None).cast("long").alias("n_pairs"),
                                     F.lit(None).cast("double").alias("corr"))
    wide = pivot(long, keys, code, value, values=codes, agg="mean",
                 names={c: f"c{i}" for i, c in enumerate(codes)})
    mat = wide.select(*[F.col(f"c{i}").cast("double") for i in range(k)])
    means = {r[0]: r[1] for r in long.filter(F.col(code).isin(codes)).groupBy(code).agg(F.avg(value)).collect()}  # k rows
    parts = mat.mapInPandas(_gram_partials(k, [float(means.get(c) or 0.0) for c in codes]), _MOMENTS)
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    res = sums.select("i", "j", F.col("n").cast("long").alias("n_pairs"),
                      corr_from_moments(F.col("n"), F.col("sx"), F.col("sy"), F.col("sxx"),
                                        F.col("syy"), F.col("sxy")).alias("corr"))
    a = bounded_broadcast(names.select(F.col("idx").alias("i"), F.col("code").alias("code_a")), k, "one row per code")
    b = bounded_broadcast(names.select(F.col("idx").alias("j"), F.col("code").alias("code_b")), k, "one row per code")
    return res.join(a, "i").join(b, "j").select("code_a", "code_b", "n_pairs", "corr")


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Guarded Pearson correlation of two columns over complete pairs (per group)."""
    both = col_ref(x).isNotNull() & col_ref(y).isNotNull()
    aggs = [F.count_if(both).alias("n_pairs"), guarded_corr(col_ref(x), col_ref(y)).alias("corr")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def simple_regression(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """One-regressor OLS by aggregates: slope, intercept, R^2 and pair count."""
    yy, xx = col_ref(y), col_ref(x)
    aggs = [F.regr_count(yy, xx).alias("n"), F.regr_slope(yy, xx).alias("slope"),
            F.regr_intercept(yy, xx).alias("intercept"), F.regr_r2(yy, xx).alias("r2")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R^2 as cor(p, y)^2 (``postResample``) and the coefficient of determination."""
    p, y = F.col(prediction), F.col(label)
    both = p.isNotNull() & y.isNotNull()
    aggs = [F.count_if(both).alias("n"),
            F.sqrt(F.avg(F.when(both, F.pow(p - y, 2)))).alias("rmse"),
            F.avg(F.when(both, F.abs(p - y))).alias("mae"),
            F.pow(guarded_corr(p, y), 2).alias("r2_corr"),
            F.sum(F.when(both, F.pow(y - p, 2))).alias("_sse"),
            F.var_pop(F.when(both, y)).alias("_vy")]
    g = pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)
    r2 = 1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n"))
    return g.withColumn("r2", r2).drop("_sse", "_vy")


def _coef_frame(spark: SparkSession, names, est, se, tv, pv) -> DataFrame:
    rows = [(n, float(e), float(s), float(t), float(p)) for n, e, s, t, p in zip(names, est, se, tv, pv)]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double, p_value double")


def ols_table(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Multiple OLS with estimate, SE, t and p per term, from one aggregation (normal equations of co-moments).

    Empty when there are not more complete rows than terms or the features are collinear."""
    k = len(features)
    m = moments.comoments(moments.complete(df, [*features, label]), [*features, label])[None]
    xx, xy = m.comoment[:k, :k], m.comoment[:k, k]
    scale = np.sqrt(np.diag(xx))
    if m.n <= k + 1 or not scale.all() or np.linalg.matrix_rank(xx / np.outer(scale, scale), tol=1e-10) < k:
        return _coef_frame(df.sparkSession, [], [], [], [], [])
    inverse = np.linalg.inv(xx / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inverse @ xy
    freedom = m.n - k - 1
    noise = max(float(m.comoment[k, k] - beta @ xy), 0.0) / freedom
    mean = m.mean[:k]
    est = [*beta, m.mean[k] - beta @ mean]
    se = np.sqrt(noise * np.append(np.diag(inverse), 1 / m.n + mean @ inverse @ mean))
    tv = [e / s if s else float("inf") for e, s in zip(est, se)]
    return _coef_frame(df.sparkSession, [*features, "(Intercept)"], est, se, tv, [moments.student_p(t, freedom) for t in tv])


def logit_table(df: DataFrame, label: str, features: Sequence[str], min_positives: int = 2, steps: int = 50) -> DataFrame:
    """Binomial GLM coefficient table by iteratively reweighted least squares: one native aggregation of weighted products a step.

    The standardised complete rows are checkpointed first, so no step reads the source again. Empty when fewer than
    ``min_positives`` positive labels, no negative ones, or a feature is constant."""
    from obsframe.session import ensure_checkpoint_dir
    spark, k = df.sparkSession, len(features)
    rows = moments.complete(df, [*features, label])
    m = moments.comoments(rows, [*features, label])[None]
    sd = np.sqrt(np.diag(m.comoment)[:k] / max(m.n, 1))
    positives = m.n * m.mean[k]
    if positives < min_positives or positives > m.n - 0.5 or not sd.all():
        return _coef_frame(spark, [], [], [], [], [])
    ensure_checkpoint_dir(spark)
    z = [((col_ref(f) - F.lit(float(a))) / F.lit(float(b))).alias(f"z{i}") for i, (f, a, b) in enumerate(zip(features, m.mean, sd))]
    rows = rows.select(*z, F.lit(1.0).alias(f"z{k}"), col_ref(label).alias("y")).checkpoint(eager=True)
    x = [F.col(f"z{i}") for i in range(k + 1)]
    beta = np.append(np.zeros(k), np.log(m.mean[k] / (1 - m.mean[k])))
    for _ in range(steps):
        mu = 1 / (1 + F.exp(-sum((x[i] * F.lit(float(beta[i])) for i in range(1, k + 1)), x[0] * F.lit(float(beta[0])))))
        r = rows.withColumn("mu", mu).withColumn("w", F.col("mu") * (1 - F.col("mu"))).agg(
            *(F.sum(x[i] * (F.col("y") - F.col("mu"))).alias(f"g{i}") for i in range(k + 1)),
            *(F.sum(F.col("w") * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(k + 1) for j in range(i, k + 1))).first()
        hessian = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
        step = np.linalg.solve(hessian, [r[f"g{i}"] for i in range(k + 1)])
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    back = np.eye(k + 1)  # standardised terms to the features' own
    back[:k, :k] = np.diag(1 / sd)
    back[k, :k] = -m.mean[:k] / sd
    est, se = back @ beta, np.sqrt(np.diag(back @ np.linalg.inv(hessian) @ back.T))
    tv = est / se
    return _coef_frame(spark, [*features, "(Intercept)"], est, se, tv, [math.erfc(abs(t) / math.sqrt(2)) for t in tv])
