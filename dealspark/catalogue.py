"""Named queries of the engine and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its oracle."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["priority_topk"](spark, sf_dir)


def _load() -> None:
    """Import the modules that register queries."""
    from dealspark.plans import deals, documents, drafts, events, records, reports, runs, sources, web  # noqa: F401


_load()
