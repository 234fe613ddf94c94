"""Query name -> callable, and query name -> oracle SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with DuckDB SQL for the same rows."""

    def add(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"query {f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    from tallyspan.plans import aggregates, cases, choices, exchange, facts, joins, projections, quality, recipes, records, releases, resolution, sets, sittings, stores, texts, trees, turns, windows, wrapped  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    load()
    return QUERIES["facts_event_weeks"](spark, sf_dir)
