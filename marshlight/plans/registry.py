"""Every registered query of the landscape operators and the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Fixtures, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the fixtures, with the SQL that states the same rows."""

    def add(fn: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Fixtures(spark, sf_dir))
        if sql:
            ORACLE[name] = oracle(sql)
        return fn

    return add


def load() -> None:
    from . import queries_audit, queries_attributes, queries_cells, queries_learning, queries_terrain, queries_vectors  # noqa: F401


load()
