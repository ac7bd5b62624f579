"""Where plan modules put their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (table) under a name; table(n) reads a table of the data folder."""

    def keep(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return keep
