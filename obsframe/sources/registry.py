"""Source registry: (logical name, reader, layout, options) -> one canonical long table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.schema import LONG_COLUMNS
from obsframe.sources import readers

LAYOUTS = {
    "indicators_long": readers.normalise_long,
    "wide_year": readers.normalise_wide,
    "wide_year_suffixed": readers.normalise_suffixed,
    "bank_prices": readers.normalise_prices,
}


@dataclass
class SourceSpec:
    """One registered source.

    ``load(spark)`` returns the raw DataFrame (CSV, Parquet, a derived view ...);
    ``layout`` picks the normaliser; ``options`` are its keyword arguments
    (source/dataset tags, id columns, excluded columns). ``order`` names a whole-number column
    that gives the order of the source's rows; without it, file position counts for frames that
    read files, and a hash of the row for derived ones.
    """
    logical: str
    load: Callable[[SparkSession], DataFrame]
    layout: str
    options: dict = field(default_factory=dict)
    order: str | None = None


def normalise(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.layout not in LAYOUTS:
        raise ValueError(f"unknown layout {spec.layout!r} for {spec.logical}")
    return LAYOUTS[spec.layout](spec.load(spark), **spec.options)


def with_row_order(df: DataFrame, ordinal: int, order: str | None = None) -> DataFrame:
    """Adds ``row_order``: (source, file, block, position, hash of the row).

    Neither part depends on how tasks are dealt: positions are only compared within one block of a
    file, which one task reads from its start to its end.
    """
    tie = F.xxhash64(*df.columns).alias("tie")

    def key(file: Column, block: Column, pos: Column) -> Column:
        return F.struct(F.lit(ordinal).alias("source"), file.alias("file"), block.cast("long").alias("block"),
                        pos.cast("long").alias("pos"), tie).alias(readers.ROW_ORDER)

    none, zero = F.lit(""), F.lit(0)
    if order is not None:
        return df.select("*", key(none, zero, F.col(order)))
    try:
        return df.select("*", key(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    except AnalysisException:  # not a scan of files
        return df.select("*", key(none, zero, zero))


def indicators_long(spark: SparkSession, specs: list[SourceSpec], drop_null_year: bool = True,
                    keep_order: bool = False) -> DataFrame:
    """Union of every normalised source (by name), rows without a year dropped.

    A plain ``Union`` of narrow scans: no shuffle; Catalyst prunes per-branch columns.
    ``keep_order`` adds each row's ``row_order``: sources in the order given, rows in file order.
    """
    if keep_order:
        specs = [replace(s, load=lambda spark, s=s, i=i: with_row_order(s.load(spark), i, s.order)) for i, s in enumerate(specs)]
    columns = [*LONG_COLUMNS, *([readers.ROW_ORDER] if keep_order else [])]
    parts = [normalise(spark, s).select(*columns) for s in specs]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.filter(F.col("year").isNotNull()) if drop_null_year else out
