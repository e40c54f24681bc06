"""How plan modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    """Adds a query, with the SQL that gives the same rows (None where SQL can't)."""
    QUERIES[name] = fn
    if sql:
        ORACLES[name] = sql


def query(sql: str | None):
    """Registers a function under its name."""

    def add(fn):
        register(fn.__name__, fn, sql)
        return fn

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
