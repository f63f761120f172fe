"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def six(column: str) -> Column:
    """Column rounded to six digits, the precision at which both engines are compared."""
    return F.round(F.col(column).cast("double"), 6).alias(column)


def big(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)
