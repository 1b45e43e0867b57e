"""Registry of named queries: Spark builder + equivalent DuckDB SQL.

Each entry is registered with ``@query(name, sql)``; the builder takes
``(spark, sf_dir)`` and returns a DataFrame whose column names equal the
SQL's.  ``sql=None`` marks a query without an SQL equivalent (checked
against a brute-force fixture in tests instead).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco
