"""Query registration."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starloom.session import configure, size_shuffles

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, by its own name unless given, with the equivalent SQL where there is one."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(size_shuffles(configure(spark), sf_dir), sf_dir)

        key = name or fn.__name__
        _QUERIES[key] = run
        if sql is not None:
            _ORACLES[key] = sql
        return run

    return register


def _load() -> None:
    from starloom.suite import arrivals, columns, listening, loads, model, profiles  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
