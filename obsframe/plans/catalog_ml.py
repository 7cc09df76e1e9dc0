"""Model and file-level queries. Of the fitted models the OLS table has a SQL oracle; pytest holds the others against other solvers.

The modelling panel is derived from the whole ``lineitem`` table (one row per ship
date); pytest checks the estimators against closed-form answers on exact data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.operators import ml, stats
from obsframe.plans import testdata as td
from obsframe.plans.registry import register, rounded
from obsframe.sources import manifest

FEATURES = ["quantity", "avg_discount", "avg_tax", "n_lines"]
LABEL = "revenue"


def _panel(spark, sf_dir):
    return ml.stored(td.daily_lineitem_panel(spark, sf_dir))


def _train_test(spark, sf_dir):
    s = ml.stratified_split(_panel(spark, sf_dir), LABEL, ["day"], train_frac=0.8, strata=5, seed=42)
    return s.filter("is_train"), s.filter(~F.col("is_train"))


def _forest(spark, sf_dir):
    tr, te = _train_test(spark, sf_dir)
    return ml.random_forest_cv(tr, te, LABEL, FEATURES, num_trees=100, folds=5, seed=42, key=["day"])


def _lasso(spark, sf_dir):
    tr, te = _train_test(spark, sf_dir)
    return ml.lasso_cv(tr, te, LABEL, FEATURES, key=["day"])


SPLIT_SQL = """
WITH li AS (SELECT l_extendedprice AS y, ('0x' || substr(md5(concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR, '42')), 1, 12))::BIGINT
                   / CAST(281474976710656 AS DOUBLE) AS u FROM lineitem),
e AS (SELECT list_sort(list(y)) AS s, count(y) AS n FROM li WHERE y IS NOT NULL),
t AS (SELECT u, CASE WHEN y IS NULL THEN -1 WHEN y <= s[ceil(0.2 * n)::BIGINT] THEN 0 WHEN y <= s[ceil(0.4 * n)::BIGINT] THEN 1
                     WHEN y <= s[ceil(0.6 * n)::BIGINT] THEN 2 WHEN y <= s[ceil(0.8 * n)::BIGINT] THEN 3 ELSE 4 END AS stratum FROM li, e),
c AS (SELECT stratum, list_sort(list(u))[ceil(0.8 * count(*))::BIGINT] AS cut FROM t GROUP BY stratum)
SELECT t.stratum, u <= cut AS is_train, count(*) AS n FROM t JOIN c ON t.stratum = c.stratum GROUP BY ALL"""


@register("stratified_split", SPLIT_SQL)
def q_stratified_split(spark, sf_dir):
    """80/20 split balanced within target quintiles (md5 of the key, seed 42): counts per cell."""
    s = ml.stratified_split(td.table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return s.groupBy("stratum", "is_train").agg(F.count(F.lit(1)).alias("n"))


# Normal equations by cofactors of the three features' co-moments; p by Simpson's rule on Student's density with t = sqrt(v) tan(angle).
OLS_SQL = """
WITH p AS (SELECT sum(l_extendedprice)::DOUBLE AS y, sum(l_quantity)::DOUBLE AS a, avg(l_discount)::DOUBLE AS b, avg(l_tax)::DOUBLE AS c
           FROM lineitem GROUP BY l_shipdate::DATE),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, n * covar_pop(a, a) AS aa, n * covar_pop(a, b) AS ab, n * covar_pop(a, c) AS ac,
             n * covar_pop(b, b) AS bb, n * covar_pop(b, c) AS bc, n * covar_pop(c, c) AS cc, n * covar_pop(a, y) AS ay, n * covar_pop(b, y) AS by_, n * covar_pop(c, y) AS cy, n * covar_pop(y, y) AS yy FROM p),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
i AS (SELECT *, (bb * cc - bc * bc) / det AS iaa, (ac * bc - ab * cc) / det AS iab, (ab * bc - ac * bb) / det AS iac,
             (aa * cc - ac * ac) / det AS ibb, (ab * ac - aa * bc) / det AS ibc, (aa * bb - ab * ab) / det AS icc FROM d),
e AS (SELECT *, iaa * ay + iab * by_ + iac * cy AS ea, iab * ay + ibb * by_ + ibc * cy AS eb, iac * ay + ibc * by_ + icc * cy AS ec FROM i),
s AS (SELECT *, n - 4 AS v, (yy - ea * ay - eb * by_ - ec * cy) / (n - 4) AS noise FROM e),
t AS (SELECT v, 'quantity' AS term, ea AS estimate, sqrt(noise * iaa) AS std_error FROM s UNION ALL
      SELECT v, 'avg_discount', eb, sqrt(noise * ibb) FROM s UNION ALL SELECT v, 'avg_tax', ec, sqrt(noise * icc) FROM s UNION ALL
      SELECT v, '(Intercept)', my - ea * ma - eb * mb - ec * mc,
             sqrt(noise * (1.0 / n + ma * (iaa * ma + iab * mb + iac * mc) + mb * (iab * ma + ibb * mb + ibc * mc) + mc * (iac * ma + ibc * mb + icc * mc))) FROM s),
w AS (SELECT *, estimate / std_error AS t_value, atan(abs(estimate / std_error) / sqrt(v)) AS low FROM t),
k AS (SELECT k, CASE WHEN k IN (0, 20000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS weight FROM range(20001) r(k)),
q AS (SELECT term, sum(weight * pow(greatest(cos(low + (pi() / 2 - low) * k / 20000), 0), v - 1)) * (pi() / 2 - low)
                   / (sum(weight * pow(greatest(cos(pi() / 2 * k / 20000), 0), v - 1)) * pi() / 2) AS p_value FROM w, k GROUP BY term, low, v)
SELECT term, printf('%.5e', estimate)::DOUBLE AS estimate, printf('%.5e', std_error)::DOUBLE AS std_error, printf('%.5e', t_value)::DOUBLE AS t_value,
       round(p_value, 6) AS p_value FROM w JOIN q USING (term)"""


@register("ols_coefficients", OLS_SQL)
def q_ols_coefficients(spark, sf_dir):
    """Multiple OLS with estimate, SE, t (six significant digits) and p per term."""
    found = stats.ols_table(td.daily_lineitem_panel(spark, sf_dir), LABEL, ["quantity", "avg_discount", "avg_tax"])
    six = {c: F.format_string("%.5e", F.col(c)).cast("double") for c in ("estimate", "std_error", "t_value")}
    return rounded(found.withColumns(six), only=["p_value"])


@register("logit_coefficients")
def q_logit_coefficients(spark, sf_dir):
    """Binomial GLM of a day flag (mean discount >= 5 %) on volume and line count."""
    p = td.daily_lineitem_panel(spark, sf_dir).withColumn(
        "high_discount", (F.col("avg_discount") >= 0.05).cast("double"))
    return stats.logit_table(p, "high_discount", ["quantity", "n_lines"])


@register("random_forest")
def q_random_forest(spark, sf_dir):
    """G6 + G9: random forest (100 trees, 5-fold CV) test metrics."""
    return _forest(spark, sf_dir)[0]


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Top-10 random forest importances rescaled to 100."""
    return _forest(spark, sf_dir)[1]


@register("lasso_cv")
def q_lasso_cv(spark, sf_dir):
    """Lasso with 5-fold CV over lambda = 10^(-4..1 step 0.5); test metrics and chosen lambda."""
    return _lasso(spark, sf_dir)[0]


@register("lasso_coefficients")
def q_lasso_coefficients(spark, sf_dir):
    """Coefficients of the CV-selected lasso."""
    return _lasso(spark, sf_dir)[1]


@register("ridge_vs_lasso")
def q_ridge_vs_lasso(spark, sf_dir):
    """Ridge (alpha 10) vs lasso (alpha 0.1) train/test R^2 and the gap."""
    tr, te = _train_test(spark, sf_dir)
    return ml.ridge_vs_lasso(tr, te, LABEL, FEATURES)


@register("kmeans_regimes")
def q_kmeans_regimes(spark, sf_dir):
    """G11 + C3: k-means (k=3, best of 10 starts) regime per day, left-joined back to the panel."""
    panel = _panel(spark, sf_dir)
    labels, _cost = ml.kmeans_best_of(panel, "day", FEATURES, k=3, starts=10, seed=42)
    return panel.join(labels, "day", "left").select("day", "revenue", "cluster")


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    """Variance explained by each principal component of the standardised features."""
    return ml.pca_variance(_panel(spark, sf_dir), FEATURES)


@register("residuals")
def q_residuals(spark, sf_dir):
    """Predicted vs actual and residual on the test days of a ridge fit."""
    tr, te = _train_test(spark, sf_dir)
    pred = te.select("day", LABEL, ml.ridge_fit(tr, LABEL, FEATURES, 10.0).column(FEATURES).alias("prediction"))
    return rounded(ml.residuals(pred, LABEL), 4)


@register("source_manifest")
def q_source_manifest(spark, sf_dir):
    """Per source file its logical name, path, size and SHA-256 (hashed on the executors)."""
    return manifest(spark, sf_dir, "*.parquet").drop("modified")
