"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) ->
DataFrame`` and, when the result is expressible in SQL, a DuckDB oracle over
the provided tables (views named like the parquet files)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, note)
        return fn
    return register
