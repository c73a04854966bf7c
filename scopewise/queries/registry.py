"""A query is a Spark function plus, where SQL can say it, reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its own name."""

    def register(function: QueryFunction) -> QueryFunction:
        QUERIES[function.__name__] = Query(function, sql)
        return function

    return register
