"""All registered queries of the engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir) under name, with SQL that gives the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    from satellion.plans import details, relational, reporting, text_and_kernels  # noqa: F401  they register on import

    return QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return ORACLES
