"""The register of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cluelake.plans.bindings import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(duckdb: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if duckdb:
            ORACLES[f.__name__] = oracle(duckdb)
        return f

    return add
