"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(col: str | Column, name: str | None = None) -> Column:
    """Six decimals, the precision at which results are compared."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6).alias(name or col)


def day(col: str = "date", name: str = "date") -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(name)


def moment(col: str, name: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
