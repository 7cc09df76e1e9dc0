"""Wide <-> long reshaping (unpivot, suffixed unpivot, pivots, snapshot, densify)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import col_ref, safe_double
from obsframe.functions.stats import strict_avg
from obsframe.schema import YEAR_SUFFIX_PATTERN

DEFAULT_MAX_WIDTH = 1000


def measure_columns(df: DataFrame, ids: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """Every column that is neither an id nor excluded: the dynamic measure set of a wide source."""
    skip = set(ids) | set(exclude)
    return [c for c in df.columns if c not in skip]


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
            code_col: str = "code", value_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """Wide -> long. Measures are cast to DOUBLE first (``unpivot`` rejects mixed types).

    Plans to a single ``Expand``; no shuffle.
    """
    values = list(values) if values is not None else measure_columns(df, ids)
    if not values:
        raise ValueError("unpivot needs at least one measure column")
    typed = df.select(*[col_ref(i) for i in ids], *[safe_double(v).alias(v) for v in values])
    out = typed.unpivot([col_ref(i) for i in ids], [col_ref(v) for v in values], code_col, value_col)
    return out.filter(F.col(value_col).isNotNull()) if drop_empty else out


def unpivot_suffixed(df: DataFrame, ids: Sequence[str], pattern: str = YEAR_SUFFIX_PATTERN,
                     code_col: str = "code", year_col: str = "year", value_col: str = "value",
                     drop_empty: bool = False) -> DataFrame:
    """``metric_YYYY`` columns -> (code=metric, year=YYYY, value).

    Only columns whose name matches ``pattern`` are melted, so a suffixed column
    without a year (``total_all``) is never turned into a NULL-year row.
    """
    rx = re.compile(pattern)
    cols = [c for c in df.columns if c not in set(ids) and rx.search(c)]
    melted = unpivot(df, ids, cols, "_wide_col", value_col, drop_empty)
    return melted.select(
        *[col_ref(i) for i in ids],
        F.regexp_replace("_wide_col", pattern, "").alias(code_col),
        F.regexp_extract("_wide_col", pattern, 1).cast("int").alias(year_col),
        F.col(value_col),
    )


def pivot_values(df: DataFrame, key: str, max_width: int = DEFAULT_MAX_WIDTH) -> list:
    """Distinct pivot keys, sorted; refuses to build a table wider than ``max_width``.

    The list is collected once (bounded by ``max_width``) so that the pivot itself
    plans as one aggregation without an extra distinct job.
    """
    rows = (df.select(col_ref(key)).where(col_ref(key).isNotNull()).distinct()
            .limit(max_width + 1).collect())
    if len(rows) > max_width:
        raise ValueError(f"pivot on {key!r} would exceed {max_width} columns; stay long")
    return sorted(r[0] for r in rows)


def _cell_agg(agg: str, key: Column, k, value: Column, order: Column | None) -> Column:
    hit = key == F.lit(k)
    if agg == "first":
        if order is None:
            raise ValueError("agg='first' needs an ordering column")
        return F.min_by(value, F.when(hit & value.isNotNull(), order))
    if agg == "last":
        if order is None:
            raise ValueError("agg='last' needs an ordering column")
        return F.max_by(value, F.when(hit & value.isNotNull(), order))
    if agg == "mean":
        return F.avg(F.when(hit, value))
    if agg == "strict_mean":
        return strict_avg(value, hit)
    if agg in ("max", "min", "sum", "count"):
        return getattr(F, agg)(F.when(hit, value))
    raise ValueError(f"unknown pivot aggregate {agg!r}")


def reduce_cells(df: DataFrame, index: list[str], key: str, value: str, agg: str,
                  order_by: str | None, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per (index, key) cell carrying what the cell aggregate needs (partial-aggregation friendly), and ``extra`` aggregates."""
    v = col_ref(value)
    if agg in ("first", "last"):
        if order_by is None:
            raise ValueError(f"agg={agg!r} needs an ordering column")
        o = F.when(v.isNotNull(), col_ref(order_by))
        cell = (F.min_by(v, o) if agg == "first" else F.max_by(v, o)).alias("_cell")
        return df.groupBy(*[col_ref(i) for i in index], col_ref(key)).agg(cell, *extra)
    if agg == "mean":
        return df.groupBy(*[col_ref(i) for i in index], col_ref(key)).agg(F.avg(v).alias("_cell"), *extra)
    if agg == "strict_mean":
        return df.groupBy(*[col_ref(i) for i in index], col_ref(key)).agg(strict_avg(v).alias("_cell"), *extra)
    if agg in ("max", "min", "sum", "count"):
        return df.groupBy(*[col_ref(i) for i in index], col_ref(key)).agg(getattr(F, agg)(v).alias("_cell"), *extra)
    raise ValueError(f"unknown pivot aggregate {agg!r}")


def pivot(df: DataFrame, index: str | Sequence[str], key: str, value: str = "value",
          values: Sequence | None = None, agg: str = "first", order_by: str | None = None,
          names: dict | None = None, max_width: int = DEFAULT_MAX_WIDTH, extra=()) -> DataFrame:
    """Long -> wide with one column per key, as conditional aggregation.

    ``agg``: ``first`` (value of the lowest ``order_by`` among non-null rows,
    deterministic, like a keep-first over the file order), ``last``, ``mean``,
    ``strict_mean`` (NULL if any input of the cell is NULL), ``max``, ``min``,
    ``sum``, ``count``. All cells of a row come from one hash aggregation with
    partial (map-side) combine, so a hot index value is pre-reduced per task.
    ``extra`` aggregates (e.g. a row total) are computed in the same pass.

    Without ``values`` the input is first reduced to one row per (index, key)
    cell and that small table is checkpointed to the shared checkpoint folder;
    the key list and the pivot both read it, so the upstream plan runs once.
    """
    index = [index] if isinstance(index, str) else list(index)
    names = names or {}
    if values is None and not extra:
        from obsframe.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        cells = reduce_cells(df, index, key, value, agg, order_by).checkpoint(eager=True)
        values = pivot_values(cells, key, max_width)
        df, value, agg, order_by = cells, "_cell", "max", None
    elif values is None:
        values = pivot_values(df, key, max_width)
    if len(values) > max_width:
        raise ValueError(f"pivot would exceed {max_width} columns")
    kcol, vcol = col_ref(key), col_ref(value)
    ocol = col_ref(order_by) if order_by else None
    cells = [_cell_agg(agg, kcol, k, vcol, ocol).alias(str(names.get(k, k))) for k in values]
    grouped = df.groupBy(*[col_ref(i) for i in index])
    if not cells and not extra:             # no key present: the index rows alone
        return grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    return grouped.agg(*cells, *extra)


def snapshot(df: DataFrame, index: str, key: str, mapping: dict, value: str = "value",
             agg: str = "max", where: Column | None = None) -> DataFrame:
    """Conditional-aggregate pivot with named output columns: ``{alias: code}``.

    SQL form: ``SELECT year, MAX(CASE WHEN code='X' THEN value END) AS alias ... GROUP BY year``.
    """
    base = df if where is None else df.filter(where)
    codes = list(mapping.values())
    return pivot(base, index, key, value, values=codes, agg=agg,
                 names={c: a for a, c in mapping.items()})


def densify(df: DataFrame, series_keys: Sequence[str], t: str = "year", value: str = "value",
            t_min: int | None = None, t_max: int | None = None) -> DataFrame:
    """Give every series every period of the panel; absent periods get a NULL value.

    One shuffle: the observations of a series (one per period, so bounded by the time axis) are
    gathered by one grouping, and the periods it lacks are added by one ``array_except``, linear in its length. The
    result stays partitioned by the series keys, so windows over a series shuffle no more.
    Several observations of one period stay several rows. The panel span is two scalars.
    """
    if t_min is None or t_max is None:
        lo, hi = df.agg(F.min(t), F.max(t)).first()
        t_min = lo if t_min is None else t_min
        t_max = hi if t_max is None else t_max
    if t_min is None:
        return df.select(*series_keys, t, value).limit(0)
    lo, hi = F.lit(int(t_min)), F.lit(int(t_max))
    seen = F.when(F.col(t).between(lo, hi), F.struct(F.col(t).alias("t"), F.col(value).alias("v")))
    obs = df.groupBy(*series_keys).agg(F.collect_list(seen).alias("_obs"))
    kind = obs.schema["_obs"].dataType.elementType
    span = F.sequence(lo, hi).cast(f"array<{kind['t'].dataType.simpleString()}>")
    absent = F.transform(F.array_except(span, F.transform("_obs", lambda o: o["t"])),
                         lambda p: F.struct(p.alias("t"), F.lit(None).cast(kind["v"].dataType).alias("v")))
    every = obs.select(*series_keys, F.explode(F.concat("_obs", absent)).alias("_o"))
    return every.select(*series_keys, F.col("_o.t").alias(t), F.col("_o.v").alias(value))
