"""Incremental ingestion of landed source files with Structured Streaming.

The reference pipeline has no stream operator; its sources arrive as files. This
module runs the same normalisers over a file stream so newly landed files are
appended to the canonical long table exactly once (the checkpoint tracks which
files were processed). ``trigger(availableNow=True)`` processes what has landed
and stops, which suits scheduled batch runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.schema import LONG_COLUMNS


def _has_files(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(path) and len(store.listStatus(path)) > 0


def ingest_files(spark: SparkSession, landing: str, schema: T.StructType,
                 normalise: Callable[[DataFrame], DataFrame], target: str, fmt: str = "csv",
                 checkpoint: str | None = None, partition_by=("source", "dataset"), options: dict | None = None):
    """Add every new file under ``landing`` to the Parquet table ``target`` exactly once.

    ``normalise`` maps the raw rows of one micro-batch to canonical long rows (any
    layout normaliser of ``obsframe.sources.readers``). The checkpoint records which
    files were consumed; each batch is written under its own ``batch_id`` partition. By
    default it lies beside the target. A target with data and a checkpoint without any do not
    belong together (files would be read a second time): that raises ``ValueError``.
    Returns the finished query.
    """
    ckpt = checkpoint or target.rstrip("/") + ".checkpoint"
    if _has_files(spark, target) and not _has_files(spark, ckpt):
        raise ValueError(f"{target} has data, but the checkpoint {ckpt} is empty")
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in {"header": "true", **(options or {})}.items():
        reader = reader.option(k, v)
    raw = reader.load(landing)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        # idempotent per micro-batch: a batch replayed after a failure overwrites only its own
        # partitions (dynamic partition overwrite keyed by batch_id), so rows land exactly once
        out = normalise(batch).select(*LONG_COLUMNS).withColumn("batch_id", F.lit(int(epoch)))
        cols = ["batch_id"] + [c for c in partition_by if c in out.columns]
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*cols).parquet(target))

    q = (raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
