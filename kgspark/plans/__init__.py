"""Plans over the test tables: one query per operator, each beside the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from . import cleaning, graphs, lookups, texts, validation  # noqa: F401
    from . import extras  # noqa: F401  # after those whose SQL it builds on

    return QUERIES, SQL
