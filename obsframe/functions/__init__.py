"""Column-level helpers: every function returns a native Spark ``Column``."""

from obsframe.functions.columns import (
    col_ref, null_if_tokens, safe_double, safe_int, signif, snake_case, trimmed, year_end_date, year_of,
)
from obsframe.functions.stats import corr_from_moments, guarded_corr, strict_avg

__all__ = [
    "col_ref", "null_if_tokens", "safe_double", "safe_int", "signif", "snake_case", "trimmed",
    "year_end_date", "year_of", "guarded_corr", "corr_from_moments", "strict_avg",
]
