"""Load every table of a folder by name; a table that fails to load becomes an alert row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsframe.schema import ALERT_SCHEMA


def list_entries(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Top-level entries of ``folder`` whose name ends with ``suffix`` (files or table directories).

    Listed through the Hadoop file system, so any store that Spark reads works; what lies
    inside a table's directory is not listed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(n for n in (s.getPath().getName() for s in found) if n.endswith(suffix))


def load_folder(spark: SparkSession, folder: str, fmt: str = "parquet", suffix: str | None = None):
    """Returns ({table_name: DataFrame}, load_alerts DataFrame).

    Every top-level ``*.{fmt}`` entry is a table named by its stem, read lazily. A
    read that fails at planning time (corrupt footer, bad header) is recorded as a
    CRITICAL ``LOAD`` alert instead of stopping the run.
    """
    suffix = suffix or f".{fmt}"
    tables, failures = {}, []
    for entry in list_entries(spark, folder, suffix):
        name = entry[: -len(suffix)]
        try:
            df = spark.read.format(fmt).option("header", True).load(folder.rstrip("/") + "/" + entry)
            _ = df.schema
            tables[name] = df
        except Exception:  # noqa: BLE001 - any load failure is reported as data
            failures.append(("CRITICAL", "LOAD", name, None, None))
    return tables, spark.createDataFrame(failures, ALERT_SCHEMA)

