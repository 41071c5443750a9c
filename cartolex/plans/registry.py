"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register
