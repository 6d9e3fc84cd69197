"""Registered queries over the driver's tables, each with SQL to check it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its check."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """Spark SQL over the named tables, given as {name} in the text."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})


def load_all() -> None:
    from touchline.catalog import events, ingest, layers, similarity, tables  # noqa: F401
