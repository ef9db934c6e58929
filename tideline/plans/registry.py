"""Queries register here with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable:
    """Register a function (spark, sf_dir) under its name; views are put before sql as common table expressions."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = (f"WITH {', '.join(views)} {sql}" if views else sql)
        return f

    return add
