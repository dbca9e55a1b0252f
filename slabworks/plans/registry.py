"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.sources import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = "") -> Callable:
    """Registers a query; ``uses`` names the fixture tables that its SQL begins with."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} stands twice")
        QUERIES[name] = f
        if sql is not None:
            tables = ", ".join(X.SQL[t] for t in uses.split())
            body = sql.strip()
            joined = ", " if body.startswith("WITH ") else " "
            SQL[name] = f"WITH {tables}{joined}{body.removeprefix('WITH ')}" if tables else body
        return f

    return put


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
