"""obsframe: indicator and time-series analytics on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` built from native
Spark SQL expressions, so Catalyst can push filters into the Parquet scan, prune
columns and plan partial (map-side) aggregation.

Layout
------
``obsframe.sources``    readers, source registry, JSON flattening, manifest, sinks, views
``obsframe.functions``  column-level helpers (safe casts, null tokens, guarded statistics)
``obsframe.operators``  reshape, clean, quality, series, marts, stats, ml, checks, sla, observe, alerts
``obsframe.plans``      bindings of the operators to concrete tables, and the query catalog
``obsframe.streaming``  incremental (file-stream) ingestion of the same normalisers
"""

from obsframe.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
