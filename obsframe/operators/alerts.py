"""Alert rules, severity routing and pipeline run events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.functions.columns import round_to

# --- fixed values: severity -> channels, and which channels are enabled by default ---
SEVERITY_ROUTING = {
    "CRITICAL": ["log_file", "json_log", "email", "slack_webhook"],
    "WARNING": ["log_file", "json_log"],
    "INFO": ["log_file"],
}
ENABLED_CHANNELS = {"log_file": True, "json_log": True, "email": False, "slack_webhook": False}
DEFAULT_CHANNEL = "log_file"


def routing_table(spark: SparkSession, routing: dict | None = None, enabled: dict | None = None) -> DataFrame:
    """(severity, channel) rows for enabled channels only (exploded config)."""
    routing = routing or SEVERITY_ROUTING
    enabled = enabled or ENABLED_CHANNELS
    rows = [(sev, ch) for sev, chans in routing.items() for ch in chans if enabled.get(ch, False)]
    return spark.createDataFrame(rows, "severity string, channel string")


def route(alerts: DataFrame, routing: dict | None = None, enabled: dict | None = None) -> DataFrame:
    """One row per (alert, enabled channel); severities without a route go to the default channel."""
    spark = alerts.sparkSession
    j = alerts.join(routing_table(spark, routing, enabled), "severity", "left")
    return j.withColumn("channel", F.coalesce(F.col("channel"), F.lit(DEFAULT_CHANNEL)))


def anomaly_rule(counts: DataFrame, critical_pct: float = 10.0) -> DataFrame:
    """``(table_name, column_name, n_anomalies, n_total)`` -> CRITICAL above critical_pct %, else WARNING."""
    pct = F.try_divide(F.col("n_anomalies") * 100.0, F.col("n_total"))
    return counts.select(F.when(pct > critical_pct, "CRITICAL").otherwise("WARNING").alias("severity"),
                         F.lit("ANOMALY").alias("category"), "table_name", "column_name",
                         round_to(pct, 2).alias("observed"))


def schema_change_rule(changes: DataFrame) -> DataFrame:
    """``(table_name, column_name, change)`` with change 'removed' -> CRITICAL, 'added' -> WARNING."""
    return changes.select(F.when(F.col("change") == "removed", "CRITICAL").otherwise("WARNING").alias("severity"),
                          F.lit("SCHEMA_CHANGE").alias("category"), "table_name", "column_name",
                          F.lit(None).cast("double").alias("observed"))


def volume_drop_rule(volumes: DataFrame, critical_pct: float = 30.0) -> DataFrame:
    """``(table_name, expected, actual)``: drop > critical_pct % CRITICAL, otherwise WARNING (every row alerts)."""
    drop = F.try_divide((F.col("expected") - F.col("actual")) * 100.0, F.col("expected"))
    return volumes.select(F.when(drop > critical_pct, "CRITICAL").otherwise("WARNING").alias("severity"),
                          F.lit("VOLUME_DROP").alias("category"), "table_name",
                          F.lit(None).cast("string").alias("column_name"), round_to(drop, 2).alias("observed"))


def null_spike_rule(nulls: DataFrame, critical_pct: float = 20.0) -> DataFrame:
    """``(table_name, column_name, null_pct)``: strictly above critical_pct CRITICAL, otherwise WARNING."""
    return nulls.select(F.when(F.col("null_pct") > critical_pct, "CRITICAL").otherwise("WARNING").alias("severity"),
                        F.lit("NULL_SPIKE").alias("category"), "table_name", "column_name",
                        round_to("null_pct", 2).alias("observed"))


def data_check_rule(results: DataFrame) -> DataFrame:
    """Check results -> WARNING when failed, INFO when passed."""
    return results.select(F.when(F.col("passed"), "INFO").otherwise("WARNING").alias("severity"),
                          F.lit("DATA_CHECK").alias("category"), "table_name", "column_name",
                          F.col("observed").cast("double").alias("observed"))


def stage_events(runs: DataFrame) -> DataFrame:
    """Run log ``(run_id, stage, started, ended, ok, rows)`` -> duration and a STAGE alert per row."""
    dur = (F.unix_timestamp("ended") - F.unix_timestamp("started")) / 60.0
    return runs.select("run_id", "stage", round_to(dur, 2).alias("duration_minutes"), "rows", "ok",
                       F.when(F.col("ok"), "INFO").otherwise("CRITICAL").alias("severity"),
                       F.lit("STAGE").alias("category"))


def latency_breaches(events: DataFrame, budgets: DataFrame) -> DataFrame:
    """Stage durations against ``budgets(stage, max_minutes)``: within / BREACH / no budget."""
    j = events.join(budgets, "stage", "left")
    status = (F.when(F.col("max_minutes").isNull(), "NO_BUDGET")
               .when(F.col("duration_minutes") <= F.col("max_minutes"), "OK").otherwise("BREACH"))
    return j.withColumn("status", status)
