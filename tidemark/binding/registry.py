"""Registered queries: a Spark builder and, where SQL can express it, its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.binding import inputs
from tidemark.binding.oracle_models import AS_OF, PORTFOLIO, compose
from tidemark.plans.enriched import Settings
from tidemark.plans.models import Models


class Context:
    """One run over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        tables = inputs.DriverTables(spark, sf_dir)
        self.table, self.raw, self.sql = tables.table, tables.raw, tables.sql
        self.models = Models(tables.bronze, Settings(as_of=AS_OF, portfolio_url=PORTFOLIO))


Builder = Callable[[Context], DataFrame]
BUILDERS: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Builder, oracle: str | None = None) -> None:
    if name in BUILDERS:
        raise ValueError(f"{name} is registered twice")
    BUILDERS[name] = build
    if oracle is not None:
        ORACLES[name] = oracle


def query(name: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def keep(build: Builder) -> Builder:
        register(name, build, oracle)
        return build

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Context(spark, sf_dir))

    return {name: runner(build) for name, build in BUILDERS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLES.items()}
