"""Sinks: CSV exports, the partitioned Parquet warehouse, JSON reports, temp views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _no_void(df: DataFrame) -> DataFrame:
    """Untyped NULL columns cannot be written to CSV; give them STRING type."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType)
                       else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, single_file: bool = False, order_by: Sequence[str] = ()) -> None:
    """CSV with header, overwrite. ``single_file`` only for small final exports: their rows meet in one
    task at the end, while all work before stays spread.

    ``order_by`` sorts the export with NULLs last; sorting happens only here, at the edge.
    """
    out = _no_void(df)
    keys = [F.col(c).asc_nulls_last() for c in order_by]
    if single_file:
        out = out.repartition(1)
        out = out.sortWithinPartitions(*keys) if keys else out
    elif keys:
        out = out.orderBy(*keys)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_warehouse(df: DataFrame, path: str, partition_by: Sequence[str] = ("source", "dataset")) -> None:
    """Parquet partitioned by ``partition_by`` (later filters on them prune directories)."""
    w = _no_void(df).write.mode("overwrite")
    cols = [c for c in partition_by if c in df.columns]
    (w.partitionBy(*cols) if cols else w).parquet(path)


def write_report(df: DataFrame, path: str, run_ts: str | None = None) -> None:
    """Append a result/alert table as JSON lines, stamped with the run timestamp."""
    out = df.withColumn("run_ts", F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp())
    out.write.mode("append").json(path)


def register_views(spark: SparkSession, tables: dict) -> list[str]:
    """``createOrReplaceTempView`` for each named DataFrame (the SQL surface)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def save_model(model, path: str) -> None:
    """Persist a fitted Spark ML model (overwrite)."""
    model.write().overwrite().save(path)
