"""Kafka topics. The connector jar and all options come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_topic(spark: SparkSession, options: Mapping[str, str], topic: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).option("subscribe", topic).load()


def write_topic(df: DataFrame, options: Mapping[str, str], topic: str) -> None:
    """Send the ``value`` column of a batch frame."""
    df.select("value").write.format("kafka").options(**options).option("topic", topic).save()
