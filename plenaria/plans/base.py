"""Where queries are registered, by name, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
