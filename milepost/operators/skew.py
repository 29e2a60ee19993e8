"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task should get at most where keys are salted.
TARGET_ROWS = 2_000_000


def _hash(keys: Sequence[str], types: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types)])


def _common_types(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> list[str]:
    """Types that both sides' keys are compared in; an int and a bigint hash differently."""
    both = a.select(*keys).union(b.select(*keys))
    return [f.dataType.simpleString() for f in both.schema.fields]


def hot_keys(df: DataFrame, keys: Sequence[str], target_rows: int = TARGET_ROWS) -> DataFrame:
    """(hot, salts): hashes of the keys with more than ``target_rows`` rows, and into how many parts each is cut.

    Rows are counted map-side first, and the result is a table, so neither the number of hot keys nor their size has a
    limit. Several uses should share one written result.
    """
    types = [dict(df.dtypes)[k] for k in keys]
    counts = df.groupBy(_hash(keys, types).alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > target_rows).select(
        "hot", F.ceil(F.col("n") / target_rows).cast("int").alias("salts")
    )


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join a fact to a dimension with one row per key; ``keys`` carry the same names on both sides.

    No side is hinted and nothing runs while the plan is built: a small dimension is broadcast by Spark's own size
    check, and of a large one the adaptive join splits the fact's skewed partitions. ``hot``, a result of ``hot_keys``
    over keys of the joined types, also salts: fact rows of those keys are spread over as many sub-keys as their
    count asks for, and only their dimension rows are repeated. The salt depends on the row and its task number, so a
    retried task gives the same rows the same salts and equal copies of one row still spread.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted lookup cannot be a {how} join: it would repeat dimension rows")
    keys = list(keys)
    right_keys = {k: f"__r_{k}" for k in keys}
    right = dim.withColumnsRenamed(right_keys)
    if hot is None:
        joined = fact.join(right, _match(fact, right, keys, null_safe), how)
        return joined.drop(*right_keys.values())
    types = _common_types(fact, dim, keys)
    cut = hot.select(F.col("hot").alias("__hot"), F.col("salts").alias("__salts"))
    spread = F.pmod(row_hash(fact.columns), F.coalesce("__salts", F.lit(1))).cast("int")
    left = (
        fact.withColumn("__h", _hash(keys, types)).join(cut, F.col("__h") == F.col("__hot"), "left")
        .withColumn("__salt", spread).drop("__h", "__hot", "__salts")
    )
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    right = (
        right.withColumn("__h", _hash(list(right_keys.values()), types)).join(cut, F.col("__h") == F.col("__hot"), "left")
        .withColumn("__rsalt", parts).drop("__h", "__hot", "__salts")
    )
    condition = _match(left, right, keys, null_safe) & (left["__salt"] == right["__rsalt"])
    return left.join(right, condition, how).drop(*right_keys.values(), "__salt", "__rsalt")


def row_hash(columns: Sequence[str]) -> Column:
    """A non-negative number from a row and its task, the same in a retried task and far from the largest bigint."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) + F.spark_partition_id()


def _match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for k in keys:
        a, b = left[k], right[f"__r_{k}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition
