"""Registered queries: one per operator / pipeline of SURVEY §2, each run on
the driver's tables through the stand-ins, plus the equivalent DuckDB SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE_SQL[name]`` is the
same result in ANSI SQL over the pre-registered tables. Both sides alias
every computed column to the same name. Operators whose result depends on a
hash only Spark computes (repeatable draws) have no SQL entry and are
checked by property tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from .standins import (  # noqa: F401
        mart, scalars, joins, aggs, windows, sets, sources, documents, pricing, reports)


_load_all()
