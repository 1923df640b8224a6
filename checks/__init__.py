"""Queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under an operator's name, with its SQL where there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def load_all() -> None:
    from checks import (  # noqa: F401
        columns,
        features,
        metrics,
        ordering,
        plans,
        profile,
        sources,
        text,
    )
