"""Registered queries: one callable per operator and, where SQL can say it, its SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (
    "scalars",
    "cleaning",
    "profiling",
    "slices",
    "splits",
    "features",
    "metrics",
    "neighbours",
    "models",
    "storage",
    "jobs",
)


class Registry:
    """Collects the queries of one module with their SQL twins."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"Query {name} is registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def collect_registries() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in MODULES:
        registry = importlib.import_module(f"{__name__}.{module}").registry
        clash = queries.keys() & registry.queries.keys()
        if clash:
            raise ValueError(f"Queries registered in two modules: {sorted(clash)}")
        queries.update(registry.queries)
        sql.update(registry.sql)
    return queries, sql
