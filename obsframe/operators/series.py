"""Per-series window operators on long data: interpolate, fill, winsorise, scale, growth, forecasts.

A series is identified by ``keys`` (e.g. code, or code + entity) and ordered by a
period column ``t``. Inputs carry at most one row per (series, period) — pre-aggregate
raw facts first — so a window partition is bounded by the length of the time axis,
not by data volume. All operators of one chain partition by the same keys, so
Spark shuffles once and reuses that partitioning for every later window.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsframe.operators import selection
from obsframe.operators.joins import measured_broadcast


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def interpolate(df: DataFrame, keys, t: str = "year", value: str = "value", axis: str = "year",
                out: str | None = None) -> DataFrame:
    """Linear gap interpolation, interior only; leading and trailing gaps stay NULL.

    ``axis='year'`` interpolates on the period value, ``axis='position'`` on the
    row position within the series (identical without holes in the time axis).
    """
    keys = _keys(keys)
    out = out or value
    order = Window.partitionBy(*keys).orderBy(t)
    base = df
    x = F.col(t).cast("double")
    if axis == "position":
        base = df.withColumn("_pos", F.row_number().over(order).cast("double"))
        x = F.col("_pos")
    elif axis != "year":
        raise ValueError("axis must be 'year' or 'position'")
    known = F.when(F.col(value).isNotNull(), F.struct(x.alias("x"), F.col(value).alias("v")))
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    lo = F.last(known, ignorenulls=True).over(before)
    hi = F.first(known, ignorenulls=True).over(after)
    res = (base.withColumn("_lo", lo).withColumn("_hi", hi))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(
        F.col("_lo").isNotNull() & F.col("_hi").isNotNull(),
        F.col("_lo.v") + (F.col("_hi.v") - F.col("_lo.v"))
        * F.try_divide(x - F.col("_lo.x"), F.col("_hi.x") - F.col("_lo.x")),
    )
    res = res.withColumn(out, filled).drop("_lo", "_hi")
    return res.drop("_pos") if axis == "position" else res


def mean_fill(df: DataFrame, keys, value: str = "value", out: str | None = None) -> DataFrame:
    """Remaining gaps get the series mean (a series without any value stays NULL)."""
    keys = _keys(keys)
    return df.withColumn(out or value,
                         F.coalesce(F.col(value), F.avg(value).over(Window.partitionBy(*keys))))


def winsorize(df: DataFrame, keys, value: str = "value", lower: float = 0.05, upper: float = 0.95,
              out: str | None = None, approx_accuracy: int | None = None, distributed: bool = False) -> DataFrame:
    """Clip each series to its [lower, upper] quantiles.

    Exact linear (R type 7) quantiles by default. For groups too long for one task, ``distributed`` finds the same
    quantiles by ``selection`` and joins them, and ``approx_accuracy`` switches to ``percentile_approx``.
    """
    keys = _keys(keys)
    if distributed:
        q = selection.quantiles(df, keys, value, [lower, upper]).select(F.struct(*keys).alias("_g"), F.col("q").alias("_q"))
        v = F.col(value)
        clipped = F.when(v.isNotNull(), F.greatest(F.col("_q")[0], F.least(F.col("_q")[1], v)))
        return df.withColumn("_g", F.struct(*keys)).join(measured_broadcast(q), "_g", "left").withColumn(out or value, clipped).drop("_g", "_q")
    w = Window.partitionBy(*keys)
    if approx_accuracy:
        q = F.percentile_approx(value, [lower, upper], approx_accuracy).over(w)
    else:
        q = F.percentile(value, F.array(F.lit(lower), F.lit(upper))).over(w)
    res = df.withColumn("_q", q)
    v = F.col(value)
    clipped = F.when(v.isNotNull(), F.greatest(F.col("_q")[0], F.least(F.col("_q")[1], v)))
    return res.withColumn(out or value, clipped).drop("_q")


def zscore(df: DataFrame, keys, value: str = "value", out: str | None = None) -> DataFrame:
    """(v - mean) / sample sd per series; NULL when sd is 0 or undefined."""
    keys = _keys(keys)
    w = Window.partitionBy(*keys)
    return df.withColumn(out or value,
                         F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w)))


def rolling_sd(df: DataFrame, keys, t: str = "year", value: str = "value", window: int = 5,
               out: str = "rolling_sd") -> DataFrame:
    """Sample sd over the last ``window`` rows of each series (current row included)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(t).rowsBetween(-(window - 1), Window.currentRow)
    return df.withColumn(out, F.stddev_samp(value).over(w))


def regime(df: DataFrame, keys, t: str = "year", value: str = "value", flat_band_pct: float = 1.0,
           out: str = "regime") -> DataFrame:
    """'up' / 'flat' / 'down' from the % change against the previous row of the series."""
    w = Window.partitionBy(*_keys(keys)).orderBy(t)
    chg = F.try_divide(F.col(value) - F.lag(value).over(w), F.abs(F.lag(value).over(w))) * 100.0
    lab = (F.when(chg.isNull(), F.lit(None).cast("string"))
            .when(chg > flat_band_pct, "up").when(chg < -flat_band_pct, "down").otherwise("flat"))
    return df.withColumn("change_pct", chg).withColumn(out, lab)


def series_gap(df: DataFrame, index, code: str, a: str, b: str, value: str = "value") -> DataFrame:
    """Per index row: value of code ``a``, of code ``b`` and their difference a - b."""
    index = _keys(index)
    c = F.col(code)
    g = df.groupBy(*index).agg(F.max(F.when(c == a, F.col(value))).alias("a_value"),
                               F.max(F.when(c == b, F.col(value))).alias("b_value"))
    return g.withColumn("gap", F.col("a_value") - F.col("b_value"))


def cagr(df: DataFrame, keys, t: str = "year", value: str = "value") -> DataFrame:
    """Compound growth (last/first)^(1/(n-1)) - 1 over non-null rows; n counts rows, not years."""
    keys = _keys(keys)
    v = F.col(value)
    g = df.filter(v.isNotNull()).groupBy(*keys).agg(
        F.min_by(v, F.col(t)).alias("first_value"), F.max_by(v, F.col(t)).alias("last_value"),
        F.min(t).alias("first_year"), F.max(t).alias("last_year"), F.count(v).alias("n"))
    rate = F.pow(F.try_divide(F.col("last_value"), F.col("first_value")),
                 F.try_divide(F.lit(1.0), F.col("n") - 1)) - 1
    return g.withColumn("cagr", rate)


def yoy_growth(df: DataFrame, keys, t: str = "year", value: str = "value", out: str = "growth") -> DataFrame:
    """Percent change against the previous row of the series."""
    w = Window.partitionBy(*_keys(keys)).orderBy(t)
    return df.withColumn(out, F.try_divide(F.col(value) - F.lag(value).over(w), F.lag(value).over(w)) * 100.0)


def growth_scenarios(df: DataFrame, keys, t: str = "year", level: str = "value", growth: str = "growth",
                     horizon: int = 15) -> DataFrame:
    """last * (1 + r/100)^h for r in {mu - sigma, mu, mu + sigma}, h = 1..horizon.

    mu and sigma (sample) are over the growth series, ``last`` is the last
    non-null level and the years continue from its year.
    """
    keys = _keys(keys)
    lv = F.col(level)
    stats = df.groupBy(*keys).agg(
        F.avg(growth).alias("mu"), F.stddev_samp(growth).alias("sigma"),
        F.max_by(lv, F.when(lv.isNotNull(), F.col(t))).alias("last_level"),
        F.max(F.when(lv.isNotNull(), F.col(t))).alias("last_year"))
    h = F.col("h").cast("double")
    # fixed values: the three scenario columns' names
    path = lambda r: F.col("last_level") * F.pow(1 + r / 100.0, h)
    return (stats.filter(F.col("last_level").isNotNull())
                 .select(*keys, "mu", "sigma", "last_level", "last_year",
                         F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
                 .select(*keys, (F.col("last_year") + F.col("h")).alias("year"), "h",
                         path(F.col("mu") - F.col("sigma")).alias("pessimiste"),
                         path(F.col("mu")).alias("base"),
                         path(F.col("mu") + F.col("sigma")).alias("optimiste")))


def forecast(df: DataFrame, keys, t: str = "year", value: str = "value", horizon: int = 20,
             method: str = "ar1", z: float = 1.96) -> DataFrame:
    """Many-series forecasts with 95 % bands from grouped aggregates (no per-series loop).

    drift: y_n + h*d, d = mean first difference, half-width z*s*sqrt(h*(1 + h/(n-1))),
    s = sd of the differences.
    ar1:   phi, c = regr_slope / regr_intercept of y on lag(y); mu = c/(1-phi);
    mu + phi^h (y_n - mu), half-width z*s*sqrt((1-phi^(2h))/(1-phi^2)), s = residual
    sd; falls back to drift when |phi| >= 1 or phi is undefined.
    """
    keys = _keys(keys)
    w = Window.partitionBy(*keys).orderBy(t)
    s = df.filter(F.col(value).isNotNull()).select(*keys, t, value)
    s = s.withColumn("_lag", F.lag(value).over(w))
    y, ylag = F.col(value), F.col("_lag")
    st = s.groupBy(*keys).agg(
        F.count(y).alias("n"), F.max_by(y, F.col(t)).alias("y_last"), F.max(t).alias("t_last"),
        F.avg(y - ylag).alias("d_mean"), F.stddev_samp(y - ylag).alias("d_sd"),
        F.regr_slope(y, ylag).alias("phi"), F.regr_intercept(y, ylag).alias("c"),
        F.regr_syy(y, ylag).alias("_syy"), F.regr_r2(y, ylag).alias("_r2"), F.regr_count(y, ylag).alias("_m"))
    st = st.withColumn("ar_s", F.sqrt(F.try_divide(F.col("_syy") * (1 - F.coalesce(F.col("_r2"), F.lit(1.0))),
                                                   F.col("_m") - 2)))
    h = F.col("h").cast("double")
    drift_fc = F.col("y_last") + h * F.col("d_mean")
    drift_hw = z * F.col("d_sd") * F.sqrt(h * (1 + F.try_divide(h, F.col("n") - 1)))
    phi = F.col("phi")
    mu = F.try_divide(F.col("c"), 1 - phi)
    ar_fc = mu + F.pow(phi, h) * (F.col("y_last") - mu)
    ar_hw = z * F.col("ar_s") * F.sqrt(F.try_divide(1 - F.pow(phi, 2 * h), 1 - phi * phi))
    if method == "drift":
        use_ar = F.lit(False)
    elif method == "ar1":
        use_ar = phi.isNotNull() & (F.abs(phi) < 1)
    else:
        raise ValueError("method must be 'drift' or 'ar1'")
    grid = st.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    fc = F.when(use_ar, ar_fc).otherwise(drift_fc)
    hw = F.when(use_ar, ar_hw).otherwise(drift_hw)
    return grid.select(*keys, "h", (F.col("t_last") + F.col("h")).alias(t),
                       F.when(use_ar, "ar1").otherwise("drift").alias("method"),
                       fc.alias("forecast"), (fc - hw).alias("lo95"), (fc + hw).alias("hi95"))


def forecast_auto(df: DataFrame, keys, t: str = "year", value: str = "value", horizon: int = 20, max_order: int = 3, max_diff: int = 1,
                  z: float = 1.96) -> DataFrame:
    """Forecasts of many series at once by an autoregression whose order and differencing (0 or 1) are selected per series.

    Autocovariances of each series and of its differences, about their means, come from one window and one grouped aggregation;
    the Levinson-Durbin recursion turns them into coefficients and innovation variances of every order up to ``max_order``; the
    least AICc per observation, ln(variance) + 2k/n + 2k(k+1)/(n(n-k-1)) with k = order + 2, wins (of equals, fewer differences, then the lower
    order). Forecasts and the squared weights of their bands are recursions over the horizon in higher-order functions.
    Missing values are left out before lags are taken. Series of under four values, and constant ones, get order 0 without differencing.
    """
    keys = _keys(keys)
    if max_diff not in (0, 1) or max_order < 1:
        raise ValueError("max_diff is 0 or 1, max_order at least 1")
    v = F.col(value).cast("double")
    s = df.filter(v.isNotNull() & ~F.isnan(v)).select(*keys, F.col(t).alias("_t"), v.alias("_y"))
    s = s.withColumn("_dy", F.col("_y") - F.lag("_y").over(Window.partitionBy(*keys).orderBy("_t")))
    forms = [F.struct(F.lit(0).alias("d"), F.col("_y").alias("x")), F.struct(F.lit(1).alias("d"), F.col("_dy").alias("x"))][:max_diff + 1]
    s = s.select(*keys, "_t", "_y", F.inline(F.array(*forms))).filter("x IS NOT NULL")
    series, by_time = Window.partitionBy(*keys, "d"), Window.partitionBy(*keys, "d").orderBy("_t")
    s = s.withColumn("m", F.avg("x").over(series)).withColumn("x", F.col("x") - F.col("m"))
    s = s.withColumns({f"l{i}": F.lag("x", i).over(by_time) for i in range(1, max_order + 1)})
    lags = ["x", *(f"l{i}" for i in range(1, max_order))]
    st = s.groupBy(*keys, "d").agg(
        F.count(F.lit(1)).alias("n"), F.first("m").alias("m"), F.max("_t").alias("t_last"), F.max_by("_y", "_t").alias("y_last"),
        F.max_by(F.array(*(F.coalesce(F.col(c), F.lit(0.0)) for c in lags)), "_t").alias("recent"), F.avg(F.col("x") * F.col("x")).alias("c0"),
        *(F.coalesce(F.sum(F.col("x") * F.col(f"l{i}")), F.lit(0.0)).alias(f"s{i}") for i in range(1, max_order + 1)))
    st = st.withColumns({f"c{i}": F.col(f"s{i}") / F.col("n") for i in range(1, max_order + 1)})

    n, fits = F.col("n").cast("double"), []
    phi: list[str] = []
    st = st.withColumn("v0", F.col("c0"))
    for p in range(max_order + 1):
        if p:  # one step of Levinson-Durbin
            left = F.col(f"c{p}")
            for i, c in enumerate(phi):
                left = left - F.col(c) * F.col(f"c{p - 1 - i}")
            st = st.withColumn(f"k{p}", F.coalesce(F.try_divide(left, F.col(f"v{p - 1}")), F.lit(0.0)))
            new = [f"a{p}_{i}" for i in range(p)]
            st = st.withColumns({new[i]: F.col(c) - F.col(f"k{p}") * F.col(phi[p - 2 - i]) for i, c in enumerate(phi)} | {new[-1]: F.col(f"k{p}"), f"v{p}": F.col(f"v{p - 1}") * (1 - F.col(f"k{p}") * F.col(f"k{p}"))})
            phi = new
        k = float(p + 2)
        usable = (n > k + 1) & (F.col(f"v{p}") > 0)
        score = F.when(usable, F.ln(f"v{p}") + 2 * k / n + 2 * k * (k + 1) / (n * (n - k - 1)))
        if p == 0:  # always there for the undifferenced series; a constant one needs nothing else
            score = F.when(F.col("d") == 0, F.when(F.col("c0") <= 0, F.lit(-1e300)).otherwise(F.coalesce(score, F.lit(1e300)))).otherwise(score)
        weights = [F.col(c) for c in phi] + [F.lit(0.0)] * (max_order - p)
        fits.append(F.struct(score.alias("score"), F.col("d").alias("d"), F.lit(p).alias("p"), F.array(*weights).alias("phi"), F.col(f"v{p}").alias("v"),
                             "m", "y_last", "t_last", "recent"))
    best = st.select(*keys, F.explode(F.array(*fits)).alias("f")).filter("f.score IS NOT NULL").groupBy(*keys).agg(F.min("f").alias("f")).select(*keys, "f.*")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    def push(x, recent):
        return F.slice(F.concat(F.array(x), recent), 1, max_order)

    def step(a, h):
        x, weight, again = dot(F.col("phi"), a["x"]), F.element_at(a["psi"], 1), F.col("d") == 1
        level = F.when(again, a["level"] + F.col("m") + x).otherwise(F.col("m") + x)
        total = a["total"] + weight
        var = a["var"] + F.col("v") * F.pow(F.when(again, total).otherwise(weight), 2)
        return F.struct(push(x, a["x"]).alias("x"), push(dot(F.col("phi"), a["psi"]), a["psi"]).alias("psi"), level.alias("level"), total.alias("total"), var.alias("var"),
                        F.concat(a["out"], F.array(F.struct(h.alias("h"), level.alias("fc"), F.sqrt(var).alias("sd")))).alias("out")).cast(kind)

    kind = "struct<x:array<double>,psi:array<double>,level:double,total:double,var:double,out:array<struct<h:int,fc:double,sd:double>>>"
    start = F.struct(F.col("recent").alias("x"), F.array(F.lit(1.0), *[F.lit(0.0)] * (max_order - 1)).alias("psi"), F.col("y_last").alias("level"), F.lit(0.0).alias("total"),
                     F.lit(0.0).alias("var"), F.array().alias("out")).cast(kind)
    paths = best.withColumn("path", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda a: a["out"]))
    return paths.select(*keys, "t_last", "d", "p", F.inline("path")).select(
        *keys, "h", (F.col("t_last") + F.col("h")).alias(t), F.col("d").alias("diff"), F.col("p").alias("order"), F.col("fc").alias("forecast"),
        (F.col("fc") - z * F.col("sd")).alias("lo95"), (F.col("fc") + z * F.col("sd")).alias("hi95"))


def chain_clean(df: DataFrame, keys, t: str = "year", value: str = "value",
                lower: float = 0.05, upper: float = 0.95) -> DataFrame:
    """The panel cleaning chain: interpolate -> mean fill -> winsorise -> z-score, one shuffle.

    Adds columns v_interp, v_filled, v_winsor, v_scaled next to the input value.
    """
    out = interpolate(df, keys, t, value, out="v_interp")
    out = mean_fill(out, keys, "v_interp", out="v_filled")
    out = winsorize(out, keys, "v_filled", lower, upper, out="v_winsor")
    return zscore(out, keys, "v_winsor", out="v_scaled")
