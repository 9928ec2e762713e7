"""Where each query meets the SQL that must give the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its checking SQL when there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
