"""Names of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Doubles rounded after the last aggregate; minus zero becomes zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})
