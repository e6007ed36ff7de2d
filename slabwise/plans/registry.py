"""The query registry: a Spark callable and, where one exists, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def keep(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round aggregates, whose last bits depend on the order of addition."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, places) for c in columns})
