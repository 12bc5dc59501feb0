"""Collects queries and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir); sql: DuckDB's statement for the same rows."""

    def add(f):
        name = f.__name__
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add
