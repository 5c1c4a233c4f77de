"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrane.plans.fixtures import frame, oracle


class Tables:
    """The driver's tables and the views over them, by attribute: ``t.part``, ``t.fx_edge``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)


class Book:
    """Collects queries; ``add(name, function of Tables, SQL)``."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        self.queries[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql:
            self.sql[name] = oracle(sql)
