"""Registered queries: every operator on the driver tables, with its SQL twin."""

from starloom.suite.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
