"""Dimension build, counts, missingness, quality report, column profile, describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import round_to
from obsframe.operators import selection
from obsframe.operators.joins import measured_broadcast
from obsframe.session import ensure_checkpoint_dir

DIM_KEY = ["source", "dataset", "code", "name"]


def dimension(long: DataFrame, key: Sequence[str] = DIM_KEY) -> DataFrame:
    """dim_indicators: year span and non-null count per indicator."""
    return long.groupBy(*key).agg(
        F.min("year").alias("years_min"),
        F.max("year").alias("years_max"),
        F.count("value").alias("n_obs"),
    )


def counts(long: DataFrame, approx: bool = False) -> DataFrame:
    """One row: total rows and distinct codes (exact, or HyperLogLog++ when ``approx``)."""
    distinct = F.approx_count_distinct("code") if approx else F.count_distinct("code")
    return long.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_codes"))


def counts_by(long: DataFrame, by: Sequence[str] = ("source", "dataset")) -> DataFrame:
    return long.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def missingness(long: DataFrame, by: Sequence[str] = ("code", "name")) -> DataFrame:
    """Per group: n_nonnull, n_total, n_missing, pct_missing (100 * missing / total)."""
    agg = long.groupBy(*by).agg(F.count("value").alias("n_nonnull"), F.count(F.lit(1)).alias("n_total"))
    return (agg.withColumn("n_missing", F.col("n_total") - F.col("n_nonnull"))
               .withColumn("pct_missing", round_to(F.col("n_missing") * 100.0 / F.col("n_total"), 4)))


def quality_report(long: DataFrame, by: Sequence[str] = DIM_KEY) -> DataFrame:
    """Missingness plus year span; completeness is over the total row count.

    Publishes n_total, n_nonnull, n_missing, pct_missing, pct_complete, year_min,
    year_max (both percentages over n_total, so they never go negative).
    """
    agg = long.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count("value").alias("n_nonnull"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
    )
    pct_missing = (F.col("n_total") - F.col("n_nonnull")) * 100.0 / F.col("n_total")
    return agg.select(
        *by, "n_total", "n_nonnull", (F.col("n_total") - F.col("n_nonnull")).alias("n_missing"),
        round_to(pct_missing, 1).alias("pct_missing"), round_to(100.0 - pct_missing, 1).alias("pct_complete"),
        "year_min", "year_max",
    )


def column_profile(panel_long: DataFrame, code: str = "code", t: str = "year", value: str = "value") -> DataFrame:
    """Per code of a dense panel: n, fill %, mean, sd, min, max (4 decimals), first/last period with data.

    ``panel_long`` has one row per (code, period) of the panel, NULL where the
    code has no value (see ``reshape.densify``), so n_total is the panel length.
    """
    v = F.col(value)
    agg = panel_long.groupBy(code).agg(
        F.count(v).alias("n_non_na"),
        F.count(F.lit(1)).alias("n_total"),
        F.avg(v).alias("mean_val"),
        F.stddev_samp(v).alias("sd_val"),
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
        F.min(F.when(v.isNotNull(), F.col(t))).alias("year_min"),
        F.max(F.when(v.isNotNull(), F.col(t))).alias("year_max"),
    )
    return agg.select(
        code, F.lit("numeric").alias("type"), "n_non_na", "n_total",
        round_to(F.col("n_non_na") * 100.0 / F.col("n_total"), 1).alias("pct_filled"),
        *[round_to(c, 4).alias(c) for c in ("mean_val", "sd_val", "min_val", "max_val")],
        "year_min", "year_max",
    )


def usable_codes(long: DataFrame, code: str = "code", value: str = "value") -> DataFrame:
    """Codes with more than one non-null value and more than one distinct value."""
    v = F.col(value)
    return (long.groupBy(code).agg(F.count(v).alias("n_nonnull"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
                .filter((F.col("n_nonnull") > 1) & (F.col("_lo") < F.col("_hi")))
                .select(code, "n_nonnull"))


def describe(series: DataFrame, by: str | Sequence[str] = "code", value: str = "value",
             trim: float = 0.1, block: int = selection.BLOCK) -> DataFrame:
    """Descriptive statistics per series (the ``psych::describe`` layout).

    n, mean, sd, median, trimmed (mean without floor(trim*n) values at each end),
    mad (1.4826 * median |x - median|), min, max, range, skew, kurtosis, se.
    skew = g1 * ((n-1)/n)^1.5 and kurtosis = (g2 + 3) * ((n-1)/n)^2 - 3, with g1,
    g2 Spark's population ``skewness`` and ``kurtosis``.

    Groups may be of any size: moments come from one aggregation with map-side combine, and the median, the
    trim cut-offs and the median deviation are exact order statistics found by ``selection``; no window holds a group.
    """
    by = [by] if isinstance(by, str) else list(by)
    ensure_checkpoint_dir(series.sparkSession)
    base = series.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x")).checkpoint(eager=True)

    def middle(n: Column) -> list[Column]:
        return [F.floor((n + 1) / 2), F.ceil((n + 1) / 2)]

    def cuts(n: Column) -> list[Column]:
        return [*middle(n), F.floor(F.lit(trim) * n) + 1, n - F.floor(F.lit(trim) * n)]

    stats = F.col("stats")
    found = selection.order_statistics(base, by, "_x", cuts, block).select(
        F.struct(*by).alias("_g"), ((stats[0] + stats[1]) / 2).alias("median"), stats[2].alias("_lo"), stats[3].alias("_hi"))
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    joined = base.withColumn("_g", F.struct(*by)).join(measured_broadcast(found), "_g")
    inside = (x > lo) & (x < hi)
    agg = joined.groupBy("_g", "median", "_lo", "_hi").agg(
        F.count("_x").alias("n"),
        F.avg("_x").alias("mean"),
        F.stddev_samp("_x").alias("sd"),
        F.coalesce(F.sum(F.when(inside, x)), F.lit(0.0)).alias("_inner"),
        F.count_if(x <= lo).alias("_upto_lo"), F.count_if(x < hi).alias("_below_hi"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
        F.skewness("_x").alias("_g1"),
        F.kurtosis("_x").alias("_g2"),
    )
    cut = F.floor(F.lit(trim) * F.col("n"))
    left = F.col("n") - 2 * cut
    ends = lo * (F.col("_upto_lo") - cut) + hi * (F.col("n") - cut - F.col("_below_hi"))
    agg = agg.withColumn("trimmed", F.when(left > 0, F.when(lo == hi, lo).otherwise((F.col("_inner") + ends) / left)))
    off = joined.select("_g", F.abs(x - F.col("median")).alias("_d"))
    mad = selection.order_statistics(off, "_g", "_d", middle, block).select(
        "_g", (F.lit(1.4826) * ((stats[0] + stats[1]) / 2)).alias("mad"))
    agg = agg.join(mad, "_g", "left").select(*[F.col("_g")[c].alias(c) for c in by], *[c for c in agg.columns if c != "_g"], "mad")
    n = F.col("n").cast("double")
    out = agg.select(
        *by, "n", "mean", "sd", "median", "trimmed", "mad", "min", "max",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("_g1") * F.pow((n - 1) / n, 1.5)).alias("skew"),
        ((F.col("_g2") + 3) * F.pow((n - 1) / n, 2) - 3).alias("kurtosis"),
        (F.col("sd") / F.sqrt(n)).alias("se"),
    )
    return out.select(*by, "n", *[round_to(c, 6).alias(c) for c in
                                  ("mean", "sd", "median", "trimmed", "mad", "min", "max", "range",
                                   "skew", "kurtosis", "se")])


def describe_approx(df: DataFrame, by: str | Sequence[str] = "code", value: str = "value", trim: float = 0.1,
                    accuracy: int = 10000) -> DataFrame:
    """``describe`` for groups of any size: no window, only partially-merged aggregates.

    Median, trim cut-offs and MAD come from ``percentile_approx`` (relative rank
    error 1/accuracy); the trimmed mean averages the values between the trim
    quantiles. Pass 1 aggregates per group, pass 2 re-reads the data joined to the
    per-group statistics (one row per group) — a hot group is merged from partial
    sketches, never sorted in one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    x = F.col(value)
    base = df.filter(x.isNotNull()).select(*by, x.alias("_x"))
    q = base.groupBy(*by).agg(
        F.count("_x").alias("n"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("sd"),
        F.min("_x").alias("min"), F.max("_x").alias("max"),
        F.skewness("_x").alias("_g1"), F.kurtosis("_x").alias("_g2"),
        F.percentile_approx("_x", [trim, 0.5, 1 - trim], accuracy).alias("_q"))
    j = base.join(q.select(*by, "_q"), by)
    lo, med, hi = F.col("_q")[0], F.col("_q")[1], F.col("_q")[2]
    second = j.groupBy(*by).agg(
        F.avg(F.when((F.col("_x") >= lo) & (F.col("_x") <= hi), F.col("_x"))).alias("trimmed"),
        (F.lit(1.4826) * F.percentile_approx(F.abs(F.col("_x") - med), 0.5, accuracy)).alias("mad"))
    out = q.join(second, by)
    n = F.col("n").cast("double")
    return out.select(
        *by, "n", "mean", "sd", F.col("_q")[1].alias("median"), "trimmed", "mad", "min", "max",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("_g1") * F.pow((n - 1) / n, 1.5)).alias("skew"),
        ((F.col("_g2") + 3) * F.pow((n - 1) / n, 2) - 3).alias("kurtosis"),
        (F.col("sd") / F.sqrt(n)).alias("se"))
