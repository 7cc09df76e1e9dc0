"""Source-file manifest: logical name, source, type, path, size and SHA-256 per file."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A file up to this size is one row of Spark's file source; a larger one is read in pieces.
WHOLE_FILE_BYTES = 256 << 20
PIECE_BYTES = 8 << 20


def _hash_in_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs
    for b in batches:
        digests = []
        for path in b["path"]:
            store, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path)
            digest = hashlib.sha256()
            with store.open_input_stream(name) as f:
                while piece := f.read(PIECE_BYTES):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield b.assign(sha256=digests)


def manifest(spark: SparkSession, path: str, glob: str = "*", layout_of: dict | None = None,
             source: str | None = None, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """One row per file under ``path``: logical (file stem), source, type, path, size, sha256, modified.

    Files are hashed where they are read, and only digests reach the result: files up to
    ``whole_file_bytes`` by Spark's file source, larger ones in pieces. ``layout_of`` gives the
    type of a logical name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    small = files.where(F.col("length") <= whole_file_bytes).select(
        "path", "length", "modificationTime", F.sha2(F.col("content"), 256).alias("sha256"))
    large = files.where(F.col("length") > whole_file_bytes).select("path", "length", "modificationTime").mapInPandas(
        _hash_in_pieces, "path string, length long, modificationTime timestamp, sha256 string")
    types = F.lit(None).cast("string")
    if layout_of:
        types = F.create_map(*[F.lit(x) for kv in layout_of.items() for x in kv])[F.col("logical")]
    stem = F.regexp_extract(F.col("path"), r"([^/]+?)(\.[^./]+)?$", 1)
    return small.unionByName(large).select(
        stem.alias("logical"), F.lit(source).cast("string").alias("source"), F.col("path").alias("raw"),
        F.col("length").alias("size"), "sha256", F.col("modificationTime").alias("modified")).withColumn("type", types)
