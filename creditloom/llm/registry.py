"""The queries of this subpackage; `__spark_entry__.py` adds them when the package is present."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
