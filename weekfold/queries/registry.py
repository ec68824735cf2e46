"""Registry of (name -> Spark query, DuckDB SQL)."""

from __future__ import annotations

from weekfold.queries.base_sql import with_tables

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None, needs=()):
    """Register a Spark query; ``sql`` may refer to the derived tables in ``needs``."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(needs, sql)
        return fn

    return wrap
