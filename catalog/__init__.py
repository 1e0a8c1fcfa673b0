"""Registered queries over the benchmark tables, each with the SQL it must equal."""

from catalog.registry import ORACLES, QUERIES
from catalog import (  # noqa: F401  (importing a module registers its queries)
    county_queries,
    learning_queries,
    panel_queries,
    profile_queries,
    source_queries,
    state_queries,
)

__all__ = ["ORACLES", "QUERIES"]
