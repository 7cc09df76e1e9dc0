"""File readers and the per-layout normalisers into the canonical long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import col_ref, null_if_tokens, safe_double, safe_int
from obsframe.operators.reshape import measure_columns, unpivot, unpivot_suffixed
from obsframe.schema import LONG_COLUMNS, VALID_YEAR_MAX, VALID_YEAR_MIN, VALUE_NULL_TOKENS

ROW_ORDER = "row_order"


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, every column as STRING (no inference pass over the data).

    With ``columns`` the schema is given up front; otherwise only the header line
    is read to name the columns.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns is None:
        columns = reader.csv(path).columns  # header only: no inferSchema job over the data
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return reader.schema(schema).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, date_cols: Sequence[str] = ()) -> DataFrame:
    """CSV read as strings then cast to ``schema`` with try-casts (bad text -> NULL)."""
    raw = read_csv_strings(spark, path, [f.name for f in schema.fields])
    out = []
    for f in schema.fields:
        c = col_ref(f.name)
        if f.name in date_cols or isinstance(f.dataType, (T.DateType, T.TimestampType)):
            ts = F.try_to_timestamp(c)
            out.append((ts.cast("date") if isinstance(f.dataType, T.DateType) else ts).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(safe_double(c).alias(f.name))
        elif isinstance(f.dataType, T.IntegerType):
            out.append(safe_int(c).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*out)


def _tag(df: DataFrame, source: str, dataset: str) -> DataFrame:
    return df.withColumn("source", F.lit(source).cast("string")).withColumn("dataset", F.lit(dataset).cast("string"))


def _canonical(df: DataFrame) -> DataFrame:
    """Cast to the canonical types; text goes through try-casts, typed columns are cast directly."""
    types = dict(df.dtypes)
    year = F.col("year")
    year = year.cast("int") if types["year"] in ("int", "smallint", "tinyint") else safe_int(year)
    value, vt = F.col("value"), types["value"]
    if vt in ("double", "float"):
        value = F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value.cast("double"))
    elif vt in ("int", "bigint", "smallint", "tinyint") or vt.startswith("decimal"):
        value = value.cast("double")
    else:
        value = safe_double(value)
    return df.select(
        F.col("source").cast("string"), F.col("dataset").cast("string"), F.col("code").cast("string"),
        F.col("name").cast("string"), F.col("entity").cast("string"), year.alias("year"), value.alias("value"),
        *_order(df))


def _order(df: DataFrame) -> list[str]:
    """The row-order column, if the source carries one: normalisers pass it through."""
    return [ROW_ORDER] if ROW_ORDER in df.columns else []


def normalise_long(df: DataFrame, source: str, dataset: str, code: str = "indicator_code",
                   name: str = "indicator_name", year: str = "year", value: str = "value",
                   entity: str | None = None) -> DataFrame:
    """Layout ``indicators_long``: already one row per (code, year)."""
    e = col_ref(entity) if entity else F.lit(None).cast("string")
    base = df.select(col_ref(code).alias("code"), col_ref(name).alias("name"), e.alias("entity"),
                     col_ref(year).alias("year"), col_ref(value).alias("value"), *_order(df))
    return _canonical(_tag(base, source, dataset))


def normalise_wide(df: DataFrame, source: str, dataset: str, entity: str, year: str,
                   exclude: Sequence[str] = ()) -> DataFrame:
    """Layout ``wide_year``: one row per (entity, year), one column per code; name = code."""
    measures = measure_columns(df, [entity, year, ROW_ORDER], exclude)
    long = unpivot(df.select(col_ref(entity).alias("entity"), col_ref(year).alias("year"), *_order(df),
                             *[col_ref(m) for m in measures]),
                   ["entity", "year", *_order(df)], measures)
    return _canonical(_tag(long.withColumn("name", F.col("code")), source, dataset))


def normalise_suffixed(df: DataFrame, source: str, dataset: str, entity: str,
                       exclude: Sequence[str] = ()) -> DataFrame:
    """Layout ``wide_year_suffixed``: columns ``metric_YYYY``; only year-suffixed columns are melted."""
    keep = [c for c in df.columns if c not in set(exclude) or c == entity]
    long = unpivot_suffixed(df.select(*[col_ref(c) for c in keep]).withColumnRenamed(entity, "entity"), ["entity", *_order(df)])
    return _canonical(_tag(long.withColumn("name", F.col("code")), source, dataset))


def normalise_prices(df: DataFrame, entity: str = "bank", date: str = "date") -> DataFrame:
    """Layout ``bank_prices``: typed daily price fact."""
    from obsframe.operators.marts import typed_prices
    return typed_prices(df, entity, date)


def grapher_to_long(raw: DataFrame, country_code: str, source: str, dataset: str, code: str, name: str,
                    entity_name: str, lo: int = VALID_YEAR_MIN, hi: int = VALID_YEAR_MAX) -> DataFrame:
    """Per-country grapher CSV (Entity, Code, Year, <value>) -> canonical long for one country.

    Keeps the country's rows, requires an all-digit year within [lo, hi] and turns
    '', 'NA', 'NaN' or unparsable values into NULL.
    """
    value_col = [c for c in raw.columns if c not in ("Entity", "Code", "Year")][0]
    y = F.trim(F.col("Year"))
    v = null_if_tokens(F.col(value_col), VALUE_NULL_TOKENS)
    return (raw.filter((F.col("Code") == F.lit(country_code)) & y.rlike(r"^\d+$"))
               .select(F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), F.lit(code).alias("code"),
                       F.lit(name).alias("name"), F.lit(entity_name).alias("entity"),
                       y.cast("int").alias("year"), safe_double(v).alias("value"))
               .filter(F.col("year").between(lo, hi)))