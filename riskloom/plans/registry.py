"""Registry of checked queries: a Spark job and, where one exists, its independent SQL answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import scenario
from riskloom.session import ship_package


@dataclass
class Tables:
    """Lazy access to the driver tables and to the client tables derived from them."""

    spark: SparkSession
    root: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            if name in scenario.TABLES:
                self._cache[name] = scenario.TABLES[name](self)
            else:
                self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a job under ``name``; ``sql`` may use the scenario tables as if they were views."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = scenario.with_tables(sql)
        return fn

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, root))

        return run

    return {name: bind(fn) for name, fn in QUERIES.items()}
