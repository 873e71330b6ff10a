"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFunction
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(spark, folder)`` under ``name``."""

    def add(run: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return add
