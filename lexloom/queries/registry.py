"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``oracle`` is the same query for DuckDB."""

    def register(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name!r} is registered twice")
        _queries[name] = function
        if oracle is not None:
            _oracles[name] = oracle
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
