"""Queries by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """(queries, SQL, decorator): ``@query(sql)`` registers a function of (spark, sf_dir) by its name, with its SQL if it has some."""
    queries: dict[str, Callable] = {}
    texts: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql is not None:
                texts[f.__name__] = sql
            return f

        return add

    return queries, texts, query
