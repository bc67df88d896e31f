"""Reading the given tables, and a registry of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrylane.session import configure

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function name."""

        def register(query: Query) -> Query:
            def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
                return query(configure(spark), sf_dir)

            self.queries[query.__name__] = configured
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
