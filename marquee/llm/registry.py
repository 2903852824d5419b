"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(q, name) for name in dir(q) if name.startswith("op")}


def llm_sql() -> dict[str, str]:
    return dict(q.SQL)
