"""Registered queries of the core and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline import oracle
from plumbline import queries as q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in q.ALL}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
