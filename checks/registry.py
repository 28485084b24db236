"""Registered queries: a Spark function over the views and, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.views import Views

Query = Callable[[Views], DataFrame]
CHECKS: dict[str, tuple[Query, str | None]] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = (query, sql)
        return query

    return register
