"""Registry of named queries: a Spark builder and, where SQL can say it, the
equivalent oracle SQL for DuckDB over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: tuple[str, ...], sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco
