"""A small registry: a query gets a function that reads a table by name, and may have an SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Catalog:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def add(f: Callable[..., DataFrame]):
            self.queries[name] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
            if sql:
                self.oracles[name] = sql
            return f

        return add
