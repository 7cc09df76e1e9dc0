"""Typing, validity, deduplication and run counters of the long observation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import null_if_tokens, safe_double, safe_int
from obsframe.schema import ENTITY_NULL_TOKENS, LONG_COLUMNS, OBS_KEY, VALID_YEAR_MAX, VALID_YEAR_MIN

TEXT_COLS = ["source", "dataset", "code", "name"]


def type_long(raw: DataFrame) -> DataFrame:
    """Long rows (text or already typed) -> typed canonical rows.

    Text columns are trimmed, the entity's null tokens become NULL, year and value
    go through ``try_cast`` when they are text (bad text -> NULL, NaN -> NULL);
    columns that are already numeric are cast directly, without a text round trip.
    """
    types = dict(raw.dtypes)
    year, value = F.col("year"), F.col("value")
    year = year.cast("int") if types["year"] in ("int", "smallint", "tinyint") else safe_int(F.trim(year.cast("string")))
    if types["value"] in ("double", "float"):
        value = F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value.cast("double"))
    elif types["value"] in ("int", "bigint", "smallint", "tinyint") or types["value"].startswith("decimal"):
        value = value.cast("double")
    else:
        value = safe_double(F.trim(value.cast("string")))
    return raw.select(
        *[F.trim(F.col(c)).alias(c) for c in TEXT_COLS],
        null_if_tokens(F.trim(F.col("entity")), ENTITY_NULL_TOKENS).alias("entity"),
        year.alias("year"), value.alias("value"),
        *[c for c in raw.columns if c not in LONG_COLUMNS],
    )


def year_valid(year_col: str = "year", lo: int = VALID_YEAR_MIN, hi: int = VALID_YEAR_MAX):
    """TRUE for a year in [lo, hi]; NULL years are invalid (never NULL)."""
    return F.coalesce(F.col(year_col).between(lo, hi), F.lit(False))


def filter_years(df: DataFrame, lo: int = VALID_YEAR_MIN, hi: int = VALID_YEAR_MAX) -> DataFrame:
    return df.filter(year_valid("year", lo, hi))


def drop_null_year(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year").isNotNull())


def upper_year_cut(df: DataFrame, max_year: int, year_col: str = "year") -> DataFrame:
    """Rows up to ``max_year`` (display cut of projections)."""
    return df.filter(F.col(year_col) <= max_year)


def sample_years(df: DataFrame, years: Sequence[int], year_col: str = "year") -> DataFrame:
    """Rows of the listed years only (e.g. one year per decade)."""
    return df.filter(F.col(year_col).isin(list(years)))


def complete(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows with a value (analysis table)."""
    return df.filter(F.col(value_col).isNotNull())


def subject_scope(df: DataFrame, subject: str | None, entity_col: str = "entity") -> DataFrame:
    """Rows of the subject: NULL entity (single-country sources) or the named entity; without a name, NULL entity only."""
    e = F.col(entity_col)
    return df.filter(e.isNull() | (e == F.lit(subject))) if subject is not None else df.filter(e.isNull())


def code_filter(df: DataFrame, codes: Sequence[str], code_col: str = "code") -> DataFrame:
    """Keep listed codes, case-insensitively."""
    return df.filter(F.lower(F.col(code_col)).isin([c.lower() for c in codes]))


def dedup_first(df: DataFrame, key: Sequence[str] = OBS_KEY, order_by: str = "row_order",
                keep_order: bool = False, unique_order: bool = False) -> DataFrame:
    """Keep the first row per ``key`` by ``order_by``; NULL key parts compare equal, NULL orders come last.

    The first row of each key is the minimum of (order, hash of the row) — a hash aggregate with
    partial combine, so a key holding a third of all rows is reduced inside each map task — and
    the rows are kept by a NULL-safe semi join on (key, order, hash). That join is partitioned by
    the order too, so a hot key spreads over all tasks. Ties in ``order_by`` go to the smaller
    hash, and rows that are equal throughout are kept once. ``unique_order=True`` is the caller's
    word that no two rows share an order and none is NULL (a row id): the tie-break is left out.
    A ``row_number`` window is never used: it would sort a hot key in one task.
    """
    rest = [c for c in df.columns if c not in key and (keep_order or c != order_by)]
    if unique_order:
        firsts = df.groupBy(*key).agg(F.min(order_by).alias("_first_order"))
        cond = [df[k].eqNullSafe(firsts[k]) for k in key] + [df[order_by] == firsts["_first_order"]]
        return df.join(firsts, cond, "left_semi").select(*key, *rest)
    d = df.withColumn("_order", F.struct(F.col(order_by).isNull().alias("n"), F.col(order_by).alias("o"),
                                         F.xxhash64(*df.columns).alias("h")))
    firsts = d.groupBy(*key).agg(F.min("_order").alias("_first_order"))
    cond = [d[k].eqNullSafe(firsts[k]) for k in key] + [d["_order"].eqNullSafe(firsts["_first_order"])]
    return d.join(firsts, cond, "left_semi").select(*key, *rest).dropDuplicates(list(key))


def clean_long(raw: DataFrame, order_by: str = "row_order", lo: int = VALID_YEAR_MIN,
               hi: int = VALID_YEAR_MAX, key: Sequence[str] = OBS_KEY, unique_order: bool = False,
               keep_order: bool = False) -> DataFrame:
    """indicators_clean: typed, year-valid, deduplicated (keep first), with quality flags (and the order, if asked)."""
    typed = type_long(raw)
    valid = typed.filter(year_valid("year", lo, hi))
    kept = dedup_first(valid.select(*LONG_COLUMNS, order_by), key, order_by, keep_order, unique_order)
    return kept.select(*LONG_COLUMNS, F.lit(True).alias("year_valid"),
                       F.col("value").isNull().alias("is_missing"), *([order_by] if keep_order else []))


def run_counters(raw: DataFrame, order_by: str = "row_order", lo: int = VALID_YEAR_MIN,
                 hi: int = VALID_YEAR_MAX, key: Sequence[str] = OBS_KEY) -> DataFrame:
    """One row: n_read, n_rejected_year, n_duplicates, n_final, n_missing.

    One grouping pass over (key, valid) carries the per-key count and the first
    row's value; a final one-row aggregate sums them. NULL years count as rejected.
    """
    typed = type_long(raw).withColumn("_valid", year_valid("year", lo, hi))
    per_key = typed.groupBy(*key, "_valid").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.col("value"), F.col(order_by)).alias("_first_value"),
    )
    v = F.col("_valid")
    return per_key.agg(
        F.sum("_n").cast("long").alias("n_read"),
        F.coalesce(F.sum(F.when(~v, F.col("_n"))), F.lit(0)).cast("long").alias("n_rejected_year"),
        F.coalesce(F.sum(F.when(v, F.col("_n") - 1)), F.lit(0)).cast("long").alias("n_duplicates"),
        F.count_if(v).alias("n_final"),
        F.count_if(v & F.col("_first_value").isNull()).alias("n_missing"),
    )
