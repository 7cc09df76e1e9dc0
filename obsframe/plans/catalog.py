"""The full query catalog (importing a catalog module registers its queries)."""

from __future__ import annotations

from obsframe.plans.registry import QUERIES


def all_queries():
    from obsframe.plans import catalog_core, catalog_dq, catalog_etl, catalog_ml, catalog_series, catalog_sources  # noqa: F401
    return dict(QUERIES)
