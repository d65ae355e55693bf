"""The queries by name: the Spark side and, where SQL can say it, the DuckDB side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Inputs, oracle
from ..session import ship_package

Build = Callable[[Inputs], DataFrame]
_QUERIES: dict[str, Build] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of ``Inputs`` under its own name, with its SQL twin."""

    def add(fn: Build) -> Build:
        _QUERIES[fn.__name__] = fn
        if sql:
            _ORACLES[fn.__name__] = sql
        return fn

    return add


def _load() -> None:
    from . import aggregates, datasets, documents, files, merges, projections, scalars, sources, streams, windows  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn: Build) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Inputs(spark, sf_dir))

        return run

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: oracle(sql) for name, sql in _ORACLES.items()}
