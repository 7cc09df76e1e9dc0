"""Queries for series windows, descriptive statistics, correlation and growth (with DuckDB oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.functions.columns import round_to

from obsframe.operators import marts, quality, series, stats
from obsframe.operators.joins import measured_broadcast
from obsframe.plans import testdata as td
from obsframe.plans.catalog_core import ONW
from obsframe.plans.registry import register, rounded

# ---------------------------------------------------------------- shared SQL fragments ----

PANEL = """cells AS (SELECT event_type AS code, user_id AS entity, CAST(day(ts) AS INTEGER) AS day, avg(value) AS value
          FROM events GROUP BY ALL),
span AS (SELECT min(day) AS lo, max(day) AS hi FROM cells),
days AS (SELECT CAST(d AS INTEGER) AS day FROM (SELECT unnest(range(lo, hi + 1)) AS d FROM span)),
grid AS (SELECT k.code, k.entity, days.day FROM (SELECT DISTINCT code, entity FROM cells) k CROSS JOIN days),
panel AS (SELECT grid.code, grid.entity, grid.day, cells.value FROM grid LEFT JOIN cells USING (code, entity, day))"""

INTERP = PANEL + """,
w AS (SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER (PARTITION BY code, entity ORDER BY day
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lt,
  last_value(value IGNORE NULLS) OVER (PARTITION BY code, entity ORDER BY day
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
  first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER (PARTITION BY code, entity ORDER BY day
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ht,
  first_value(value IGNORE NULLS) OVER (PARTITION BY code, entity ORDER BY day
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hv
  FROM panel),
interp AS (SELECT code, entity, day, value,
  CASE WHEN value IS NOT NULL THEN value
       WHEN lt IS NOT NULL AND ht IS NOT NULL
       THEN lv + (hv - lv) * (CAST(day - lt AS DOUBLE) / CAST(ht - lt AS DOUBLE)) END AS v_interp FROM w)"""

CHAIN = INTERP + """,
f AS (SELECT *, coalesce(v_interp, avg(v_interp) OVER (PARTITION BY code, entity)) AS v_filled FROM interp),
r AS (SELECT *, row_number() OVER (PARTITION BY code, entity ORDER BY v_filled NULLS LAST) AS rk,
             (count(v_filled) OVER (PARTITION BY code, entity) - 1) * CAST(0.05 AS DOUBLE) AS p05,
             (count(v_filled) OVER (PARTITION BY code, entity) - 1) * CAST(0.95 AS DOUBLE) AS p95 FROM f),
qs AS (SELECT code, entity, any_value(p05) AS p05, any_value(p95) AS p95,
              any_value(v_filled) FILTER (WHERE rk = floor(p05) + 1) AS a05,
              any_value(v_filled) FILTER (WHERE rk = ceil(p05) + 1) AS b05,
              any_value(v_filled) FILTER (WHERE rk = floor(p95) + 1) AS a95,
              any_value(v_filled) FILTER (WHERE rk = ceil(p95) + 1) AS b95
       FROM r GROUP BY code, entity),
q AS (SELECT f.*,
        CASE WHEN floor(p05) = ceil(p05) OR a05 = b05 THEN a05
             ELSE (ceil(p05) - p05) * a05 + (p05 - floor(p05)) * b05 END AS q05,
        CASE WHEN floor(p95) = ceil(p95) OR a95 = b95 THEN a95
             ELSE (ceil(p95) - p95) * a95 + (p95 - floor(p95)) * b95 END AS q95
      FROM f JOIN qs ON f.code = qs.code AND f.entity = qs.entity),
wz AS (SELECT *, CASE WHEN v_filled IS NOT NULL THEN greatest(q05, least(q95, v_filled)) END AS v_winsor FROM q),
z AS (SELECT *, (v_winsor - avg(v_winsor) OVER (PARTITION BY code, entity))
                / nullif(stddev_samp(v_winsor) OVER (PARTITION BY code, entity), 0) AS v_scaled FROM wz)"""

NATION_REVENUE = ONW + """,
nr AS (SELECT n_name AS entity, CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS value
       FROM onw GROUP BY ALL)"""

GROWTH = NATION_REVENUE + """,
gr AS (SELECT entity, year, value,
              (value - lag(value) OVER (PARTITION BY entity ORDER BY year))
              / lag(value) OVER (PARTITION BY entity ORDER BY year) * CAST(100.0 AS DOUBLE) AS growth FROM nr)"""


def nation_revenue(spark, sf_dir):
    """(entity, year, value) with revenue rounded to cents at the source."""
    return td.nation_revenue(spark, sf_dir).withColumn("value", round_to("value", 2))


# ------------------------------------------------------------------------ panel ----

@register("dense_panel", "WITH " + PANEL + "\nSELECT code, entity, day, round(value, 6) AS value FROM panel")
def q_dense_panel(spark, sf_dir):
    """Every (type, user) series gets every day of the span (sequence + explode, no cross join)."""
    return rounded(td.event_panel(spark, sf_dir))


@register("interpolate", "WITH " + INTERP + """
SELECT code, entity, day, round(value, 6) AS value, round(v_interp, 6) AS v_interp FROM interp""")
def q_interpolate(spark, sf_dir):
    """E5: linear interior gap interpolation on the period axis."""
    out = series.interpolate(td.event_panel(spark, sf_dir), ["code", "entity"], "day", "value", out="v_interp")
    return rounded(out)


@register("panel_clean", "WITH " + CHAIN + """
SELECT code, entity, day, round(value, 6) AS value, round(v_interp, 6) AS v_interp, round(v_filled, 6) AS v_filled,
       round(v_winsor, 6) AS v_winsor, round(v_scaled, 6) AS v_scaled FROM z""")
def q_panel_clean(spark, sf_dir):
    """E5 -> E6 mean fill -> E7 winsorise (exact 5/95 % quantiles) -> E8 z-score, one shuffle."""
    out = series.chain_clean(td.event_panel(spark, sf_dir), ["code", "entity"], "day", "value")
    return rounded(out)


@register("column_profile", "WITH " + PANEL + """
SELECT code, 'numeric' AS type, count(value) AS n_non_na, count(*) AS n_total,
       round(CAST(count(value) AS DOUBLE) * 100 / count(*), 1) AS pct_filled,
       round(avg(value), 4) AS mean_val, round(stddev_samp(value), 4) AS sd_val,
       round(min(value), 4) AS min_val, round(max(value), 4) AS max_val,
       min(day) FILTER (WHERE value IS NOT NULL) AS year_min, max(day) FILTER (WHERE value IS NOT NULL) AS year_max
FROM panel GROUP BY code""")
def q_column_profile(spark, sf_dir):
    """Per code fill %, mean, sd, min, max and first/last period with data."""
    return quality.column_profile(td.event_panel(spark, sf_dir), "code", "day", "value")


@register("usable_series", "WITH " + PANEL + """
SELECT code, entity, count(value) AS n_nonnull FROM panel GROUP BY code, entity
HAVING count(value) > 1 AND min(value) < max(value)""")
def q_usable_series(spark, sf_dir):
    """Series with more than one value and more than one distinct value."""
    p = td.event_cells(spark, sf_dir).withColumn("series", F.struct("code", "entity"))  # periods without data add nothing
    u = quality.usable_codes(p, "series", "value")
    return u.select("series.code", "series.entity", "n_nonnull")


@register("latest_observation", "WITH " + PANEL + """
SELECT code, entity, max(day) FILTER (WHERE value IS NOT NULL) AS day,
       round(arg_max(value, day) FILTER (WHERE value IS NOT NULL), 6) AS value
FROM panel GROUP BY code, entity HAVING count(value) > 0""")
def q_latest_observation(spark, sf_dir):
    """Latest non-null observation per series."""
    return rounded(marts.latest_nonnull(td.event_cells(spark, sf_dir), ["code", "entity"], "day"))


@register("describe", """
WITH d AS (SELECT event_type AS code, CAST(day(ts) AS INTEGER) AS day, avg(value) AS x FROM events GROUP BY ALL),
m0 AS (SELECT *, count(*) OVER (PARTITION BY code) AS cnt, avg(x) OVER (PARTITION BY code) AS mu,
              row_number() OVER (PARTITION BY code ORDER BY x) AS rk,
              (count(*) OVER (PARTITION BY code) - 1) * CAST(0.5 AS DOUBLE) AS pm FROM d),
md AS (SELECT code, any_value(pm) AS pm, any_value(x) FILTER (WHERE rk = floor(pm) + 1) AS a,
              any_value(x) FILTER (WHERE rk = ceil(pm) + 1) AS b FROM m0 GROUP BY code),
m AS (SELECT m0.*, CASE WHEN floor(md.pm) = ceil(md.pm) OR a = b THEN a
                        ELSE (ceil(md.pm) - md.pm) * a + (md.pm - floor(md.pm)) * b END AS med
      FROM m0 JOIN md ON m0.code = md.code),
dev AS (SELECT code, abs(x - med) AS ad, row_number() OVER (PARTITION BY code ORDER BY abs(x - med)) AS rk2, pm FROM m),
mad AS (SELECT code, CASE WHEN floor(any_value(pm)) = ceil(any_value(pm)) THEN any_value(ad) FILTER (WHERE rk2 = floor(pm) + 1)
                          WHEN any_value(ad) FILTER (WHERE rk2 = floor(pm) + 1) = any_value(ad) FILTER (WHERE rk2 = ceil(pm) + 1)
                          THEN any_value(ad) FILTER (WHERE rk2 = floor(pm) + 1)
                          ELSE (ceil(any_value(pm)) - any_value(pm)) * any_value(ad) FILTER (WHERE rk2 = floor(pm) + 1)
                             + (any_value(pm) - floor(any_value(pm))) * any_value(ad) FILTER (WHERE rk2 = ceil(pm) + 1) END AS mad_raw
        FROM dev GROUP BY code),
a AS (SELECT code, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, any_value(med) AS median,
             avg(x) FILTER (WHERE rk > floor(0.1 * cnt) AND rk <= cnt - floor(0.1 * cnt)) AS trimmed,
             min(x) AS mn, max(x) AS mx,
             avg(power(x - mu, 2)) AS m2, avg(power(x - mu, 3)) AS m3, avg(power(x - mu, 4)) AS m4
      FROM m GROUP BY code)
SELECT a.code, n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median, round(trimmed, 6) AS trimmed,
       round(1.4826 * mad_raw, 6) AS mad, round(mn, 6) AS min, round(mx, 6) AS max, round(mx - mn, 6) AS range,
       round(m3 / power(m2, 1.5) * power((n - 1.0) / n, 1.5), 6) AS skew,
       round(m4 / power(m2, 2) * power((n - 1.0) / n, 2) - 3, 6) AS kurtosis,
       round(sd / sqrt(n), 6) AS se
FROM a JOIN mad ON a.code = mad.code""")
def q_describe(spark, sf_dir):
    """Psych-style descriptive statistics of each daily series."""
    return quality.describe(td.event_daily(spark, sf_dir), "code", "value")


@register("describe_facts", """
WITH b AS (SELECT l_returnflag AS code, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
r AS (SELECT code, x, row_number() OVER (PARTITION BY code ORDER BY x) AS rk, count(*) OVER (PARTITION BY code) AS c FROM b),
m AS (SELECT code, quantile_cont(x, 0.5) AS med FROM b GROUP BY code)
SELECT r.code, count(*) AS n, round(any_value(med), 6) AS median, round(1.4826 * quantile_cont(abs(x - med), 0.5), 6) AS mad,
       round(avg(x) FILTER (WHERE rk > floor(0.1 * c) AND rk <= c - floor(0.1 * c)), 4) AS trimmed, min(x) AS min, max(x) AS max
FROM r JOIN m ON r.code IS NOT DISTINCT FROM m.code GROUP BY r.code""")
def q_describe_facts(spark, sf_dir):
    """D10 on raw facts: exact medians, deviations and trimmed means of groups that grow with the table."""
    facts = td.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("code"), F.col("l_extendedprice").alias("value"))
    d = quality.describe(facts, "code", "value", block=5_000)
    return d.select("code", "n", "median", "mad", round_to("trimmed", 4).alias("trimmed"), "min", "max")


@register("winsor_facts", """
WITH q AS (SELECT l_returnflag, quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.95) AS hi
           FROM lineitem GROUP BY l_returnflag)
SELECT l.l_orderkey, l.l_linenumber, round(greatest(lo, least(hi, CAST(l_extendedprice AS DOUBLE))), 6) AS value
FROM lineitem l JOIN q ON l.l_returnflag IS NOT DISTINCT FROM q.l_returnflag""")
def q_winsor_facts(spark, sf_dir):
    """E7 on raw facts: every price clipped to the exact 5 and 95 % quantiles of its return flag."""
    facts = td.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_extendedprice").cast("double").alias("value"))
    clipped = series.winsorize(facts, "l_returnflag", distributed=True)
    return clipped.select("l_orderkey", "l_linenumber", round_to("value", 6).alias("value"))


# ------------------------------------------------------------------ correlation ----

@register("corr_matrix", """
WITH c AS (SELECT event_type AS code, user_id AS entity, CAST(day(ts) AS INTEGER) AS day, avg(value) AS v
           FROM events GROUP BY ALL),
codes AS (SELECT DISTINCT code FROM c),
pairs AS (SELECT a.code AS code_a, b.code AS code_b FROM codes a JOIN codes b ON a.code < b.code),
m AS (SELECT a.code AS code_a, b.code AS code_b, count(*) AS n_pairs, corr(a.v, b.v) AS r
      FROM c a JOIN c b ON a.entity = b.entity AND a.day = b.day AND a.code < b.code GROUP BY ALL)
SELECT p.code_a, p.code_b, CAST(coalesce(m.n_pairs, 0) AS BIGINT) AS n_pairs,
       round(CASE WHEN isnan(m.r) THEN NULL ELSE m.r END, 6) AS corr
FROM pairs p LEFT JOIN m USING (code_a, code_b)""")
def q_corr_matrix(spark, sf_dir):
    """G1: pairwise-complete correlation of event types over (user, day) cells, via Gram partials."""
    return rounded(stats.corr_matrix(td.event_cells(spark, sf_dir), ["entity", "day"]))


@register("pearson", """
SELECT l_returnflag, count(*) FILTER (WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL) AS n_pairs,
       round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem GROUP BY 1""")
def q_pearson(spark, sf_dir):
    """Guarded Pearson correlation per group."""
    return rounded(stats.pearson(td.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                                 ["l_returnflag"]))


@register("simple_regression", """
SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1""")
def q_simple_regression(spark, sf_dir):
    """G3 (one regressor): OLS slope, intercept and R^2 by aggregates."""
    return rounded(stats.simple_regression(td.table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity",
                                           ["l_returnflag"]))


@register("regression_metrics", """
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem GROUP BY 1),
p AS (SELECT l.l_returnflag, l.l_extendedprice AS y, f.a + f.b * l.l_quantity AS p
      FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag)
SELECT l_returnflag, count(*) AS n, round(sqrt(avg(power(p - y, 2))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
       round(power(corr(p, y), 2), 6) AS r2_corr,
       round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 6) AS r2
FROM p GROUP BY 1""")
def q_regression_metrics(spark, sf_dir):
    """RMSE, MAE, R^2 (cor^2 and coefficient of determination) of a per-group linear fit.

    The fits, one row per group, are written, measured and broadcast, so the fact rows are
    not shuffled on the low-cardinality group key.
    """
    li = td.table(spark, sf_dir, "lineitem")
    fits = measured_broadcast(stats.simple_regression(li, "l_extendedprice", "l_quantity", ["l_returnflag"]))
    pred = li.join(fits, "l_returnflag").select(
        "l_returnflag", F.col("l_extendedprice").alias("label"),
        (F.col("intercept") + F.col("slope") * F.col("l_quantity")).alias("prediction"))
    return rounded(stats.regression_metrics(pred, "label", "prediction", ["l_returnflag"]))


# ------------------------------------------------------------- growth and forecasts ----

@register("cagr", "WITH " + NATION_REVENUE + """
SELECT entity, arg_min(value, year) AS first_value, arg_max(value, year) AS last_value, min(year) AS first_year,
       max(year) AS last_year, count(value) AS n,
       round(power(arg_max(value, year) / arg_min(value, year), 1.0 / (count(value) - 1)) - 1, 6) AS cagr
FROM nr WHERE value IS NOT NULL GROUP BY entity""")
def q_cagr(spark, sf_dir):
    """Compound growth over non-null rows."""
    return rounded(series.cagr(nation_revenue(spark, sf_dir), "entity", "year", "value"), 6, only=["cagr"])


@register("growth_scenarios", "WITH " + GROWTH + """,
st AS (SELECT entity, avg(growth) AS mu, stddev_samp(growth) AS sigma,
              arg_max(value, year) FILTER (WHERE value IS NOT NULL) AS last_level,
              max(year) FILTER (WHERE value IS NOT NULL) AS last_year FROM gr GROUP BY entity),
h AS (SELECT CAST(h AS INTEGER) AS h FROM (SELECT unnest(range(1, 16)) AS h))
SELECT entity, CAST(last_year + h AS INTEGER) AS year, h,
       round(last_level * power(1 + (mu - sigma) / 100.0, h), 0) AS pessimiste,
       round(last_level * power(1 + mu / 100.0, h), 0) AS base,
       round(last_level * power(1 + (mu + sigma) / 100.0, h), 0) AS optimiste
FROM st CROSS JOIN h WHERE last_level IS NOT NULL""")
def q_growth_scenarios(spark, sf_dir):
    """Pessimistic / base / optimistic paths, last * (1 + r/100)^h, h = 1..15."""
    g = series.yoy_growth(nation_revenue(spark, sf_dir), "entity", "year", "value")
    out = series.growth_scenarios(g, "entity", "year", "value", "growth", horizon=15)
    # currency paths ~1e7-1e8: whole units keep the oracle free of last-bit float noise
    return rounded(out, 0)


def _forecast_sql(method: str) -> str:
    use_ar = "phi IS NOT NULL AND abs(phi) < 1" if method == "ar1" else "false"
    return "WITH " + NATION_REVENUE + f""",
s AS (SELECT entity, year, value, lag(value) OVER (PARTITION BY entity ORDER BY year) AS ylag FROM nr
      WHERE value IS NOT NULL),
st AS (SELECT entity, count(value) AS n, arg_max(value, year) AS y_last, max(year) AS t_last,
              avg(value - ylag) AS d_mean, stddev_samp(value - ylag) AS d_sd,
              regr_slope(value, ylag) AS phi, regr_intercept(value, ylag) AS c,
              regr_syy(value, ylag) AS syy, regr_r2(value, ylag) AS r2, regr_count(value, ylag) AS m
       FROM s GROUP BY entity),
st2 AS (SELECT *, sqrt(syy * (1 - coalesce(r2, 1.0)) / (m - 2)) AS ar_s, c / (1 - phi) AS mu FROM st),
g AS (SELECT st2.*, CAST(h AS INTEGER) AS h, CAST(h AS DOUBLE) AS hd
      FROM st2 CROSS JOIN (SELECT unnest(range(1, 21)) AS h)),
f AS (SELECT entity, h, CAST(t_last + h AS INTEGER) AS year,
             CASE WHEN {use_ar} THEN 'ar1' ELSE 'drift' END AS method,
             CASE WHEN {use_ar} THEN mu + power(phi, hd) * (y_last - mu) ELSE y_last + hd * d_mean END AS fc,
             CASE WHEN {use_ar} THEN 1.96 * ar_s * sqrt((1 - power(phi, 2 * hd)) / (1 - phi * phi))
                  ELSE 1.96 * d_sd * sqrt(hd * (1 + hd / (n - 1))) END AS hw
      FROM g)
SELECT entity, h, year, method, round(fc, 0) AS forecast, round(fc - hw, 0) AS lo95, round(fc + hw, 0) AS hi95 FROM f"""


@register("forecast_drift", _forecast_sql("drift"))
def q_forecast_drift(spark, sf_dir):
    """G14 (drift): 20-step forecasts with 95 % bands for every nation at once."""
    return rounded(series.forecast(nation_revenue(spark, sf_dir), "entity", "year", "value", 20, "drift"), 0)


@register("forecast_ar1", _forecast_sql("ar1"))
def q_forecast_ar1(spark, sf_dir):
    """G14 (AR(1) with drift fallback): 20-step forecasts with 95 % bands."""
    return rounded(series.forecast(nation_revenue(spark, sf_dir), "entity", "year", "value", 20, "ar1"), 0)


@register("forecast_auto")
def q_forecast_auto(spark, sf_dir):
    """G14 (order selection): 20-step forecasts of every nation by the autoregression of least AICc."""
    return rounded(series.forecast_auto(nation_revenue(spark, sf_dir), "entity", "year", "value", 20), 0)


@register("rolling_sd", "WITH " + NATION_REVENUE + """
SELECT entity, year, value, round(stddev_samp(value) OVER (PARTITION BY entity ORDER BY year
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling_sd FROM nr""")
def q_rolling_sd(spark, sf_dir):
    """3-period rolling sample sd per series."""
    return rounded(series.rolling_sd(nation_revenue(spark, sf_dir), "entity", "year", "value", 3), 4,
                   only=["rolling_sd"])


@register("regime", "WITH " + NATION_REVENUE + """,
c AS (SELECT entity, year, value, (value - lag(value) OVER (PARTITION BY entity ORDER BY year))
             / abs(lag(value) OVER (PARTITION BY entity ORDER BY year)) * CAST(100.0 AS DOUBLE) AS chg FROM nr)
SELECT entity, year, value, round(chg, 6) AS change_pct,
       CASE WHEN chg IS NULL THEN NULL WHEN chg > 1.0 THEN 'up' WHEN chg < -1.0 THEN 'down' ELSE 'flat' END AS regime
FROM c""")
def q_regime(spark, sf_dir):
    """Up / flat / down label from the period-on-period change (1 % band)."""
    return rounded(series.regime(nation_revenue(spark, sf_dir), "entity", "year", "value", 1.0), 6,
                   only=["change_pct"])


@register("series_gap", """
WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS code,
                  round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY ALL)
SELECT year, max(CASE WHEN code = 'R' THEN value END) AS a_value, max(CASE WHEN code = 'A' THEN value END) AS b_value,
       round(max(CASE WHEN code = 'R' THEN value END) - max(CASE WHEN code = 'A' THEN value END), 2) AS gap
FROM s GROUP BY year""")
def q_series_gap(spark, sf_dir):
    """Gap between two series by period (returned 'R' vs accepted 'A' revenue)."""
    li = td.table(spark, sf_dir, "lineitem")
    s = li.groupBy(F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("code")).agg(
        round_to(F.sum("l_extendedprice"), 2).alias("value"))
    return rounded(series.series_gap(s, "year", "code", "R", "A"), 2, only=["gap"])


@register("executive_summary", "WITH " + GROWTH + """,
s AS (SELECT * FROM gr WHERE entity = 'NATION_7'),
a AS (SELECT CAST(min(year) AS DOUBLE) AS first_year, CAST(max(year) AS DOUBLE) AS last_year,
             CAST(count(value) AS DOUBLE) AS n_years,
             round(100 * (power(arg_max(value, year) / arg_min(value, year), 1.0 / (count(value) - 1)) - 1), 4) AS cagr_pct,
             CAST(count(*) FILTER (WHERE growth < 0) AS DOUBLE) AS recession_years,
             round(avg(growth), 4) AS growth_mean, round(stddev_samp(growth), 4) AS growth_sd FROM s)
SELECT 'first_year' AS metric, first_year AS value FROM a UNION ALL SELECT 'last_year', last_year FROM a
UNION ALL SELECT 'n_years', n_years FROM a UNION ALL SELECT 'cagr_pct', cagr_pct FROM a
UNION ALL SELECT 'recession_years', recession_years FROM a UNION ALL SELECT 'growth_mean', growth_mean FROM a
UNION ALL SELECT 'growth_sd', growth_sd FROM a""")
def q_executive_summary(spark, sf_dir):
    """D16 + B22: (metric, value) summary of the subject's series, recession years counted."""
    g = series.yoy_growth(nation_revenue(spark, sf_dir), "entity", "year", "value")
    s = g.filter(F.col("entity") == td.SUBJECT_NATION)
    v = F.col("value")
    a = s.agg(
        F.min("year").cast("double").alias("first_year"), F.max("year").cast("double").alias("last_year"),
        F.count(v).cast("double").alias("n_years"),
        round_to(100 * (F.pow(F.try_divide(F.max_by(v, "year"), F.min_by(v, "year")), F.try_divide(F.lit(1.0), F.count(v) - 1)) - 1), 4).alias("cagr_pct"),
        F.count_if(F.col("growth") < 0).cast("double").alias("recession_years"),
        round_to(F.avg("growth"), 4).alias("growth_mean"), round_to(F.stddev_samp("growth"), 4).alias("growth_sd"))
    return a.unpivot([], a.columns, "metric", "value")


@register("decade_sample", "WITH " + GROWTH + """,
sc AS (SELECT entity, avg(growth) AS mu, arg_max(value, year) AS last_level, max(year) AS last_year FROM gr GROUP BY entity),
proj AS (SELECT entity, CAST(last_year + h AS INTEGER) AS year, last_level * power(1 + mu / 100.0, h) AS value
         FROM sc CROSS JOIN (SELECT CAST(h AS INTEGER) AS h FROM (SELECT unnest(range(1, 31)) AS h)))
SELECT entity, year, round(value, 0) AS value FROM (SELECT entity, year, value FROM nr UNION ALL SELECT * FROM proj)
WHERE year <= 2024 AND year IN (1995, 2000, 2010, 2020)""")
def q_decade_sample(spark, sf_dir):
    """B25 + B28: observed and base-path projected values, cut at 2024, sampled once per decade."""
    from obsframe.operators import clean
    nr = nation_revenue(spark, sf_dir)
    g = series.yoy_growth(nr, "entity", "year", "value")
    proj = series.growth_scenarios(g, "entity", "year", "value", "growth", horizon=30).select(
        "entity", "year", F.col("base").alias("value"))
    both = nr.select("entity", "year", "value").unionByName(proj)
    return rounded(clean.sample_years(clean.upper_year_cut(both, 2024), [1995, 2000, 2010, 2020]), 0)
