"""Tables in a database. Drivers, addresses and credentials come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
) -> DataFrame:
    """Scan a table; with a partition column, in ``partitions`` parallel ranges."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
        )
    return reader.load()


def append_table(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
