"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetally.plans import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """Puts the named views in front of the text as common table expressions."""
    sql = sql.strip()
    parts = [f"{v} as ({fixtures.SQL[v].strip()})" for v in views]
    if sql.lower().startswith("with "):
        return "with recursive " + ",\n".join([*parts, sql[5:].strip()])
    return ("with recursive " + ",\n".join(parts) + "\n" if parts else "") + sql


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = with_views(sql, views)
        return fn

    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums depend on the order of addition in their last bits; rounding hides that."""
    return df.withColumns({n: F.round(n, digits) for n in names})
