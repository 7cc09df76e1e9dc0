"""Readers, source registry, JSON flattening, manifest, sinks and views."""

from obsframe.sources.json_pages import flatten_nested, flatten_paged
from obsframe.sources.manifest import manifest
from obsframe.sources.readers import (
    grapher_to_long, normalise_long, normalise_prices, normalise_suffixed, normalise_wide, read_csv_strings,
    read_csv_typed,
)
from obsframe.sources.registry import SourceSpec, indicators_long
from obsframe.sources.sinks import register_views, save_model, write_csv, write_report, write_warehouse
from obsframe.sources.tables import load_folder

__all__ = [
    "flatten_nested", "flatten_paged", "manifest", "grapher_to_long", "normalise_long", "normalise_prices",
    "normalise_suffixed", "normalise_wide", "read_csv_strings", "read_csv_typed", "SourceSpec",
    "indicators_long", "register_views", "save_model", "write_csv", "write_report", "write_warehouse",
    "load_folder",
]
