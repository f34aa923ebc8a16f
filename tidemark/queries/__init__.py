"""Queries over the supplied tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.queries import cleaning, detection, joins, learning, similarity, streams, tables, usage

_MODULES = (joins, cleaning, usage, similarity, tables, learning, streams, detection)

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    """Every query by name."""
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    """SQL with the same result, by query name."""
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
