"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabularium.plans.star_schema import StarSchema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable:
    """Register a function of the tables under its name, with its SQL if there is one."""

    def register(build: Callable[[StarSchema], DataFrame]) -> Callable[[StarSchema], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(StarSchema(spark, folder.rstrip("/")))

        run.__name__ = build.__name__
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register
