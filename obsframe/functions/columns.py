"""Scalar column helpers (typing, text cleanup, dates, rounding)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(df):
    """NaN is a missing value: floating columns get NULL in its place."""
    return df.select(*[F.nanvl(col_ref(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else col_ref(f.name) for f in df.schema.fields])


def col_ref(name: str) -> Column:
    """Reference a column whose name may contain dots or dashes (codes such as NY.GDP.MKTP.CD)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_col(c) -> Column:
    return col_ref(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    """Text or number to DOUBLE; unparsable text and NaN both become NULL (one null model)."""
    x = _as_col(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def safe_int(c) -> Column:
    """Text or number to INT; '2020', '2020.0' and 2020.0 all give 2020, bad text gives NULL."""
    x = _as_col(c)
    as_double = x.try_cast("double")
    whole = F.when(F.isnan(as_double) | (F.floor(as_double) != as_double), None).otherwise(as_double)
    return whole.try_cast("int")


def trimmed(c) -> Column:
    return F.trim(_as_col(c))


def null_if_tokens(c, tokens) -> Column:
    """NULL when the (trimmed) text is one of ``tokens``."""
    x = _as_col(c)
    return F.when(F.trim(x).isin(list(tokens)), F.lit(None).cast("string")).otherwise(x)


def year_of(c) -> Column:
    """Calendar year of a date, timestamp or ISO text; unparsable text gives NULL."""
    x = _as_col(c)
    return F.year(F.coalesce(x.try_cast("date"), F.try_to_timestamp(x.cast("string")).cast("date")))


def year_end_date(c) -> Column:
    """An integer year as 31 December of that year (freshness of yearly tables)."""
    return F.make_date(_as_col(c).cast("int"), F.lit(12), F.lit(31))


def round_to(c, digits: int) -> Column:
    """Round a DOUBLE to ``digits`` decimals, half away from zero on the binary value.

    This is C's ``round(x * 10^d) / 10^d`` (what most SQL engines do for DOUBLE),
    computed exactly: the integer part is split off, and the fractional part of
    ``x * 10^d`` is exact, so the half-way test has no rounding error of its own.
    Spark's built-in ``round`` instead rounds the shortest decimal text of the
    double, which differs on values such as 133.2581875. Zero keeps its sign.
    """
    x = _as_col(c).cast("double")
    m = F.lit(float(10 ** digits))
    y = x * m
    t = F.when(y >= 0, F.floor(y)).otherwise(F.ceil(y)).cast("double")
    r = F.when(F.abs(y - t) >= 0.5, t + F.signum(y)).otherwise(t)
    exact = F.abs(y) >= F.lit(4503599627370496.0)          # 2^52: y is already integral
    return (F.when(x.isNull() | F.isnan(x), x).when(exact, y / m)
             .when(r == 0, y * 0.0).otherwise(r / m))


def signif(c, digits: int) -> Column:
    """Round to ``digits`` significant digits (NULL and 0 pass through)."""
    x = _as_col(c)
    mag = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - mag)
    return F.when(x.isNull() | (x == 0), x).otherwise(round_to(x * scale, 0) / scale)


def snake_case(name: str) -> str:
    """Header normalisation: 'GDP Growth (%)' -> 'gdp_growth'; 'NY.GDP.MKTP.CD' -> 'ny_gdp_mktp_cd'."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        return "x"
    return "x" + s if s[0].isdigit() else s
