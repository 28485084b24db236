"""Registered queries over the given tables, each next to its DuckDB twin."""

from checks import aggregates, filters_and_sets, functions, jobs, joins, sources_and_sinks  # noqa: F401
from checks.registry import CHECKS

__all__ = ["CHECKS"]
