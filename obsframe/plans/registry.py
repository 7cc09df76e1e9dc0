"""Query catalog: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import round_to

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register a query builder ``fn(spark, sf_dir) -> DataFrame`` with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """Round DOUBLE columns at the presentation edge so float summation order cannot leak."""
    out = []
    for f in df.schema.fields:
        hit = isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only) and f.name not in skip
        out.append(round_to(F.col(f"`{f.name}`"), digits).alias(f.name) if hit else F.col(f"`{f.name}`"))
    return df.select(*out)
