"""DataFrame -> DataFrame operators grouped by concern."""

from obsframe.operators import (  # noqa: F401
    alerts, checks, clean, joins, marts, ml, observe, quality, reshape, series, sla, stats,
)
