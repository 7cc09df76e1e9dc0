"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the Python workers, once per context (as ``--py-files`` does), from the shared folder."""
    sc = spark.sparkContext
    if not getattr(sc, "_obsframe_shipped", False):
        root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"obsframe-code-{uuid.uuid4().hex}.zip"))
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(packed.getvalue()))
        out.close()
        sc.addPyFile(path.toString())
        sc._obsframe_shipped = True
    return spark


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back, so that a lost
    executor re-reads files instead of recomputing the lineage."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge: ``(node, component)``.

    ``edges`` holds long columns ``a`` and ``b``. Alternates large-star and small-star
    steps (each node's neighbours are hung onto its smallest neighbour) as joins and
    hash aggregates; the number of rounds is logarithmic in the longest chain. Edges are
    never collected; each round is checkpointed. A node whose neighbours make up much of
    the table is safe: minima are combined before the shuffle, and the join back to the
    neighbours is one that Spark splits when a key is skewed.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = cut(e)
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        e = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a <> b").distinct())
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = (e.join(low, "a")
             .select(F.inline(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
             .where("a <> b").distinct())
        e = cut(e)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    leaves = e.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = e.select(F.col("b").alias("node")).distinct().join(leaves.select("node"), "node", "left_anti")
    return leaves.unionByName(roots.select("node", F.col("node").alias("component")))


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]
