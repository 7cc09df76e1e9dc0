"""Service-level checks: freshness tiers, volume ranges, compliance report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.functions.columns import round_to
from obsframe.schema import FRESHNESS_TIER_HOURS


def tier_config(spark: SparkSession, tiers: dict, hours: dict | None = None) -> DataFrame:
    """(tier, max_age_hours, table_name): the tier -> tables config exploded."""
    hours = hours or FRESHNESS_TIER_HOURS
    rows = [(t, float(hours[t]), name) for t, names in tiers.items() for name in names]
    return spark.createDataFrame(rows, "tier string, max_age_hours double, table_name string")


def volume_config(spark: SparkSession, ranges: dict) -> DataFrame:
    """(table_name, min_rows, max_rows, expected) of ``{table: (min, max, expected)}``."""
    rows = [(k, int(lo), int(hi), int(exp)) for k, (lo, hi, exp) in ranges.items()]
    return spark.createDataFrame(rows, "table_name string, min_rows long, max_rows long, expected long")


def table_timestamps(spark: SparkSession, paths: dict, fmt: str = "parquet") -> DataFrame:
    """(table_name, updated_at): newest file modification time per table, one row per file and no contents read."""
    frames = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(p)
              .agg(F.max("modificationTime").alias("updated_at")).select(F.lit(name).alias("table_name"), "updated_at")
              for name, p in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def freshness_sla(updated: DataFrame, as_of: str, config: DataFrame) -> DataFrame:
    """FRESH / STALE / MISSING per configured table; age in hours to 1 decimal.

    ``updated(table_name, updated_at)`` may come from file metadata or from the
    newest event time of each table; ``as_of`` pins the clock so runs repeat.
    """
    j = config.join(updated, "table_name", "left")
    # wall-clock arithmetic on TIMESTAMP_NTZ: independent of the session time zone
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp_ntz"))
           - F.unix_timestamp(F.col("updated_at").cast("timestamp_ntz"))) / 3600.0
    status = (F.when(F.col("updated_at").isNull(), "MISSING")
               .when(age <= F.col("max_age_hours"), "FRESH").otherwise("STALE"))
    return j.select("table_name", "tier", status.alias("status"), round_to(age, 1).alias("age_hours"),
                    F.col("max_age_hours").alias("sla_hours"))


def volume_sla(counts: DataFrame, config: DataFrame) -> DataFrame:
    """OK / BREACH for each configured table that exists (missing tables are skipped)."""
    j = counts.join(config, "table_name", "inner")
    ok = F.col("actual").between(F.col("min_rows"), F.col("max_rows"))
    return j.select("table_name", "actual", "expected", "min_rows", "max_rows",
                    F.when(ok, "OK").otherwise("BREACH").alias("status"))


def table_counts(frames: dict) -> DataFrame:
    """(table_name, actual) row counts of named DataFrames, as one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("table_name"), "actual")
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def sla_report(freshness: DataFrame, volume: DataFrame) -> DataFrame:
    """Per SLA kind: total, passed (FRESH / OK) and the tables in breach (one row per configured table goes in)."""
    f = freshness.select(F.lit("freshness").alias("kind"), "table_name", (F.col("status") == "FRESH").alias("ok"))
    v = volume.select(F.lit("volume").alias("kind"), "table_name", (F.col("status") == "OK").alias("ok"))
    late = F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("table_name")))), ",")
    return f.unionByName(v).groupBy("kind").agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("passed"), late.alias("details"))
