"""Where registered queries and their SQL are kept."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add
