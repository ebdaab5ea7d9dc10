"""Registry of queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from curbair.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that checks it."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(pin_session(spark), folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return run

    return register
