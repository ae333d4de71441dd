"""Where queries and their reference SQL are collected."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARED: dict[str, str] = {}


# Means of rounded scores can fall exactly between two roundings, where the engines' last bits
# decide. Both sides add this before rounding, which moves the border off such values.
NUDGE = 3.1e-9


def steady(column: str, digits: int = 6):
    """The Spark side of `steady_sql`, under the same name."""
    return F.round(F.col(column) + NUDGE, digits).alias(column)


def steady_sql(expression: str, digits: int = 6) -> str:
    return f"round({expression} + {NUDGE!r}, {digits})"


def shared(name: str, sql: str) -> None:
    """A named SQL table (prefix `t_`) that reference queries may select from."""
    SHARED[name] = sql


def with_shared(sql: str) -> str:
    """`sql` preceded by the shared tables it uses, in dependency order. Names that begin with `t_`
    are shared tables; one that nobody defines is an error."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bt_[a-z_]+\b", text))):
            if name not in SHARED:
                raise KeyError(f"no shared SQL table is named {name}")
            if name not in needed:
                visit(SHARED[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    # Materialized: several queries read a shared table more than once.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({SHARED[n]})" for n in needed) + "\n" + sql


def query(name: str, sql: str | None = None):
    """Registers a query; `sql` is the equivalent DuckDB text, None where SQL cannot say it."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def oracles() -> dict[str, str]:
    """The SQL of all queries with the shared tables in it; resolved here and not when a query is
    registered, so the order in which modules are imported does not matter."""
    return {name: with_shared(sql) for name, sql in ORACLES.items()}


def _deciles() -> str:
    """The nine inner deciles of the sorted list `s.l` as a list, interpolated linearly from the nearer
    neighbour. DuckDB's own function rounds differently in the last bit, which moves values that
    equal an edge to the other bin."""
    def edge(i: int) -> str:
        h = f"(len(s.l) - 1) * {i * 0.1!r}e0"
        low = f"s.l[cast(floor({h}) as bigint) + 1]"
        high = f"s.l[least(cast(floor({h}) as bigint) + 2, len(s.l))]"
        part = f"({h} - floor({h}))"
        return (f"case when {part} >= 0.5e0 then {high} - ({high} - {low}) * (1 - {part}) "
                f"else {low} + ({high} - {low}) * {part} end")

    return "[" + ", ".join(edge(i) for i in range(1, 10)) + "]"


def edges_sql(key: str, value: str, source: str) -> str:
    """Per key the inner deciles of a column: columns key, edges."""
    return (f"select s.{key}, {_deciles()} as edges from ("
            f"select {key}, list_sort(list(cast({value} as double))) as l from ({source}) r "
            f"group by {key}) s")
