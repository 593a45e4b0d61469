"""Every operator as a named query over the test tables, with the same result in DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def load() -> None:
    """Import the modules whose queries register themselves."""
    from facetide.plans import (
        queries_learning, queries_prepare, queries_records, queries_sampling, queries_scoring, queries_stream)

    del queries_learning, queries_prepare, queries_records, queries_sampling, queries_scoring, queries_stream
