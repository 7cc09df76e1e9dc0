"""Flatten landed API responses (JSON text columns) into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_RECORDS = "array<struct<date:string,value:double>>"
NESTED_VALUES = "struct<values:map<string,map<string,map<string,double>>>>"


def flatten_paged(pages: DataFrame, json_col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """``[{paging meta}, [{"date": .., "value": ..}, ...]]`` per row -> one row per record.

    The record array is element 1 of the top-level array; each page is parsed
    where it lies (narrow), no shuffle.
    """
    keep = keep or []
    recs = F.from_json(F.get_json_object(F.col(json_col), "$[1]"), PAGE_RECORDS)
    return (pages.select(*keep, F.explode_outer(recs).alias("r"))
                 .where(F.col("r").isNotNull())
                 .select(*keep, F.col("r.date").alias("date"), F.col("r.value").alias("value")))


def flatten_nested(docs: DataFrame, json_col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """``{"values": {code: {country: {year: value}}}}`` -> (code, country, year, value)."""
    keep = keep or []
    parsed = docs.select(*keep, F.from_json(F.col(json_col), NESTED_VALUES).alias("d"))
    lvl1 = parsed.select(*keep, F.explode("d.values").alias("code", "by_country"))
    lvl2 = lvl1.select(*keep, "code", F.explode("by_country").alias("country", "by_year"))
    lvl3 = lvl2.select(*keep, "code", "country", F.explode("by_year").alias("year_text", "value"))
    return lvl3.select(*keep, "code", "country", F.col("year_text").try_cast("int").alias("year"), "value")
