"""Readers and writers."""

from cropweave.sources.geojson import (
    as_multi_polygons,
    collections,
    explode_features,
    read_collections,
    write_collections,
)
from cropweave.sources.grid import flatten_grid
from cropweave.sources.records import expand_records
from cropweave.sources.sinks import read_features, write_features, write_yields
from cropweave.sources.survey import (
    broken_files,
    broken_payloads,
    missing_requests,
    parse_payloads,
    read_payloads,
    reconcile_requests,
    request_plan,
)
from cropweave.sources.weather import canonical_weather, read_weather

__all__ = [
    "as_multi_polygons",
    "broken_files",
    "broken_payloads",
    "canonical_weather",
    "collections",
    "expand_records",
    "explode_features",
    "flatten_grid",
    "missing_requests",
    "parse_payloads",
    "read_collections",
    "read_features",
    "read_payloads",
    "read_weather",
    "reconcile_requests",
    "request_plan",
    "write_collections",
    "write_features",
    "write_yields",
]
