"""Observability: z-score anomalies, null share, volume drop, schema drift, mean drift.

Each function returns alert rows ``severity, category, table_name, column_name,
observed`` (plus category-specific metrics), so alert frames union into one table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import col_ref, nan_to_null, round_to
from obsframe.schema import (
    ALERT_SCHEMA, ANOMALY_CRITICAL_PCT, ANOMALY_MIN_VALUES, NULL_PCT_CRITICAL, NULL_PCT_WARN,
    VOLUME_DROP_CRITICAL_PCT, VOLUME_DROP_WARN_PCT, Z_SCORE_THRESHOLD,
)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def _long_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, x) for every numeric cell: one Expand, no shuffle."""
    return nan_to_null(df).select(*[col_ref(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "x")


def stat_columns(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, Column]:
    """The aggregates that ``null_share`` and the first pass of ``anomalies`` need, to be computed together with others
    in one pass: row count, nulls of every column, and count, mean and sd of the numeric ``columns``."""
    out = {"_n": F.count(F.lit(1))} | {f"_z{i}": F.count_if(col_ref(c).isNull()) for i, c in enumerate(df.columns)}
    for i, c in enumerate(columns if columns is not None else numeric_columns(df)):
        x = col_ref(c).cast("double")
        out |= {f"n{i}": F.count(x), f"m{i}": F.avg(x), f"s{i}": F.stddev_samp(x)}
    return out


def anomalies(df: DataFrame, table: str, columns: Sequence[str] | None = None,
              z: float = Z_SCORE_THRESHOLD, min_values: int = ANOMALY_MIN_VALUES,
              critical_pct: float = ANOMALY_CRITICAL_PCT, stats: DataFrame | None = None) -> DataFrame:
    """Per numeric column with >= min_values values and sample sd > 0: count |z| > ``z``.

    share > critical_pct % -> CRITICAL, any -> WARNING, none -> INFO.
    Two scans of the wide table, each ONE global aggregate with map-side partials
    (no unpivot, no shuffle of cells): first count/mean/sd of every column (one
    row, bounded by the number of columns), then the conditional counts using
    those statistics as literals. ``stats`` is a stored row of ``stat_columns``, if one exists.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    spark, df = df.sparkSession, nan_to_null(df)
    if not columns:
        return spark.createDataFrame([], ALERT_SCHEMA)
    xs = [col_ref(c).cast("double") for c in columns]
    if stats is None:
        stats = df.agg(*[e.alias(k) for k, e in stat_columns(df, columns).items()])
    st = stats.first()
    keep = [(i, c) for i, c in enumerate(columns)
            if st[f"n{i}"] >= min_values and st[f"s{i}"] is not None and st[f"s{i}"] > 0]
    schema = ("severity string, category string, table_name string, column_name string, observed double, "
              "n_anomalies long, n_values long, mean double, std double")
    if not keep:
        return spark.createDataFrame([], schema)
    counts = df.agg(*[F.count_if(F.abs((xs[i] - F.lit(st[f"m{i}"])) / F.lit(st[f"s{i}"])) > z).alias(f"a{i}")
                      for i, _ in keep])
    cells = counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"a{i}").alias("n_anomalies"), F.lit(st[f"n{i}"]).alias("n"),
        F.lit(float(st[f"m{i}"])).alias("mean"), F.lit(float(st[f"s{i}"])).alias("std")) for i, c in keep])))
    pct = F.col("n_anomalies") * 100.0 / F.col("n")
    sev = (F.when(F.col("n_anomalies") == 0, "INFO").when(pct > critical_pct, "CRITICAL").otherwise("WARNING"))
    return cells.select(sev.alias("severity"), F.lit("ANOMALY").alias("category"), F.lit(table).alias("table_name"),
                        "column_name", round_to(pct, 2).alias("observed"), "n_anomalies",
                        F.col("n").cast("long").alias("n_values"),
                        round_to("mean", 4).alias("mean"), round_to("std", 4).alias("std"))


def null_share(df: DataFrame, table: str, warn_pct: float = NULL_PCT_WARN,
               critical_pct: float = NULL_PCT_CRITICAL, stats: DataFrame | None = None) -> DataFrame:
    """Per column null %: >= critical CRITICAL, >= warn WARNING; quiet columns emit nothing.
    ``stats`` is a stored row of ``stat_columns``, if one exists."""
    cols, df = df.columns, nan_to_null(df)
    one = stats if stats is not None else df.agg(*[e.alias(k) for k, e in stat_columns(df, []).items()])
    cells = one.select("_n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_z{i}").alias("nulls")) for i, c in enumerate(cols)])))
    pct = F.try_divide(F.col("nulls") * 100.0, F.col("_n"))
    sev = F.when(pct >= critical_pct, "CRITICAL").when(pct >= warn_pct, "WARNING")
    return (cells.select(sev.alias("severity"), F.lit("NULL").alias("category"), F.lit(table).alias("table_name"),
                         "column_name", round_to(pct, 2).alias("observed"))
                 .filter(F.col("severity").isNotNull()))


def volume_drop(volumes: DataFrame, critical_pct: float = VOLUME_DROP_CRITICAL_PCT,
                warn_pct: float = VOLUME_DROP_WARN_PCT) -> DataFrame:
    """``volumes(table_name, actual, expected)``; drop % = 100 * (expected - actual) / expected."""
    drop = F.try_divide((F.col("expected") - F.col("actual")) * 100.0, F.col("expected"))
    sev = F.when(drop > critical_pct, "CRITICAL").when(drop > warn_pct, "WARNING")
    return (volumes.select(sev.alias("severity"), F.lit("VOLUME").alias("category"), "table_name",
                     F.lit(None).cast("string").alias("column_name"), round_to(drop, 2).alias("observed"))
             .filter(F.col("severity").isNotNull()))


def schema_drift(spark: SparkSession, table: str, actual_columns: Sequence[str],
                 expected_columns: Sequence[str]) -> DataFrame:
    """Missing columns CRITICAL, added WARNING, neither INFO (metadata only)."""
    actual, expected = set(actual_columns), set(expected_columns)
    missing, added = sorted(expected - actual), sorted(actual - expected)
    rows = [("CRITICAL", "SCHEMA", table, c, None) for c in missing]
    rows += [("WARNING", "SCHEMA", table, c, None) for c in added]
    if not missing and not added:
        rows.append(("INFO", "SCHEMA", table, None, None))
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def mean_drift_scores(df: DataFrame, baseline: DataFrame, z: float = Z_SCORE_THRESHOLD) -> DataFrame:
    """Per numeric column: z = |mean - base_mean| / base_std and ``drifted`` (z > threshold).

    ``baseline(column_name, base_mean, base_std)``; columns whose baseline sd is 0 are skipped.
    """
    cur = _long_numeric(df, numeric_columns(df)).groupBy("column_name").agg(F.avg("x").alias("current_mean"))
    j = cur.join(baseline.filter(F.col("base_std") != 0), "column_name", "inner")
    score = F.abs(F.col("current_mean") - F.col("base_mean")) / F.col("base_std")
    return j.select("column_name", score.alias("z"), "current_mean", "base_mean", (score > z).alias("drifted"))


def mean_drift(df: DataFrame, table: str, baseline: DataFrame, z: float = Z_SCORE_THRESHOLD) -> DataFrame:
    """DRIFT alerts (WARNING) for columns whose mean moved more than ``z`` baseline sds."""
    s = mean_drift_scores(df, baseline, z).filter(F.col("drifted"))
    return s.select(F.lit("WARNING").alias("severity"), F.lit("DRIFT").alias("category"),
                    F.lit(table).alias("table_name"), "column_name", round_to("z", 2).alias("observed"))


def baseline_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, base_mean, base_std) of every numeric column — input of ``mean_drift``."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    return _long_numeric(df, cols).groupBy("column_name").agg(F.avg("x").alias("base_mean"),
                                                              F.stddev_samp("x").alias("base_std"))


def alert_table(*frames: DataFrame) -> DataFrame:
    """Union of alert frames on the common alert columns."""
    cols = [f.name for f in ALERT_SCHEMA.fields]
    return reduce(lambda a, b: a.unionByName(b), [f.select(*[F.col(c).cast(ALERT_SCHEMA[c].dataType) for c in cols])
                                                  for f in frames])


def severity_counts(alerts: DataFrame) -> DataFrame:
    """One row: total_alerts, critical, warnings, info."""
    s = F.col("severity")
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"), F.count_if(s == "CRITICAL").alias("critical"),
                      F.count_if(s == "WARNING").alias("warnings"), F.count_if(s == "INFO").alias("info"))
