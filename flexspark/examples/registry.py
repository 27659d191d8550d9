"""Registered queries: a function (spark, folder of Parquet tables) -> DataFrame, and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql=None`` where SQL cannot express the result."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return register


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def load_wide(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Table read with at least as many partitions as there are cores, for work that is heavy per row.

    Only inputs of fewer splits than cores, like the small test files, are shuffled for it.
    """
    from flexspark.sources.read import FlexReader

    cores = spark.sparkContext.defaultParallelism
    return FlexReader(spark, min_partitions=cores).from_options("parquet", {"paths": [f"{folder}/{table}.parquet"]}).df


def exact_sum(column: str):
    """Sum of two-decimal amounts, exact and so the same in any order."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")
