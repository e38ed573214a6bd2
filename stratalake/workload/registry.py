"""Queries by name, each with the SQL that gives the same rows from the flat tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.workload.shared import Layers
from stratalake.workload.sql import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Layers], DataFrame]], Query]:
    """Register a function of the layers; ``sql`` may use the views of ``workload.sql``."""

    def register(build: Callable[[Layers], DataFrame]) -> Query:
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(Layers(spark, folder))

        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = call
        if sql is not None:
            SQL[name] = with_views(sql)
        return call

    return register
