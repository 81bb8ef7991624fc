"""Registered queries, each beside the SQL that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

MODULES = ("tables", "features", "scores", "segments", "sequences", "models", "explain", "reports", "sinks")


def load_queries() -> tuple[dict[str, QueryFunction], dict[str, str]]:
    """Import every query module and merge its queries and SQL."""
    functions: dict[str, QueryFunction] = {}
    statements: dict[str, str] = {}
    for name in MODULES:
        module = import_module(f"retailscope.queries.{name}")
        functions.update(module.QUERIES)
        statements.update(module.SQL)
    return functions, statements
