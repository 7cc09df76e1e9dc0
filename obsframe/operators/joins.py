"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, bound_rows: int, why: str) -> DataFrame:
    """Broadcast a side that is bounded by construction (one row per cluster, per code of a width-checked list).

    ``bound_rows`` states the bound. Sides read from storage or computed from the data go
    through ``measured_broadcast`` or are left to Spark.
    """
    if bound_rows <= 0 or bound_rows > 1_000_000:
        raise ValueError(f"broadcast bound {bound_rows} is not a small constant ({why})")
    return F.broadcast(df)


def measured_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Checkpoint a reduced side to the shared folder, count it there, and broadcast it if it is small.

    Beyond ``max_rows`` the checkpointed side is joined without a hint. The upstream plan runs once.
    """
    from obsframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    return F.broadcast(stored) if stored.count() <= max_rows else stored
