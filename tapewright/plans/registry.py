"""Named queries over the given tables, each with its check in plain SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapewright.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return function
    return register
