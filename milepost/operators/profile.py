"""Descriptions of a table: summaries, counts, shares, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.operators.ordered import exact_percentiles


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), name: str = "column") -> DataFrame:
    """Numeric columns as rows (keys, name, value).

    Exploded rather than unpivoted: a plan that reads the rows twice then shares one shuffle.
    """
    rows = F.array(*[F.struct(F.lit(c), F.col(c).cast("double")) for c in columns])
    return df.select(*keys, F.inline(rows).alias(name, "value"))


def describe(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Rows (column, n, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    def summary(column: str) -> Column:
        x = F.col(column).cast("double")
        return F.struct(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ).alias(column)

    wide = df.agg(*[summary(c) for c in columns])
    moments = wide.unpivot([], list(columns), "column", "s").select("column", "s.*")
    long = melt(df, columns)
    quartiles = (
        exact_percentiles(long, "value", [0.25, 0.5, 0.75], ["column"], buckets)
        .groupBy("column")
        .agg(*[
            F.max(F.when(F.col("share") == s, F.col("percentile"))).alias(f"q{int(s * 100)}")
            for s in (0.25, 0.5, 0.75)
        ])
    )
    return moments.join(quartiles, "column", "left").select(
        "column", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, n, days, first, last, mean) of timestamp columns; nulls are left out."""
    def summary(column: str) -> Column:
        at = F.col(column).cast("timestamp")
        return F.struct(
            F.count(at).alias("n"), F.count_distinct(F.to_date(at)).alias("days"), F.min(at).alias("first"), F.max(at).alias("last"),
            F.timestamp_micros(F.avg(F.unix_micros(at)).cast("bigint")).alias("mean"),
        ).alias(column)

    return df.agg(*[summary(c) for c in columns]).unpivot([], list(columns), "column", "s").select("column", "s.*")


def time_histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Rows (bin, lower, upper, n) of all equal bins between the first and the last time."""
    seconds = df.select(F.unix_micros(F.col(column).cast("timestamp")).alias("t"))
    edge = lambda c: F.timestamp_micros(F.col(c).cast("bigint")).alias(c)
    return histogram(seconds, "t", bins).select("bin", edge("lower"), edge("upper"), "n")


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Counts per value without nulls, most frequent first or in value order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), column)


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Number of rows equal to an earlier row on ``keys`` (all columns by default)."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, nulls, null_share) from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot(["__n"], columns, "column", "nulls").select(
        "column", "nulls", F.try_divide("nulls", "__n").alias("null_share")
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Rows (column, type, n, non_null, distinct_values) of every column, also of a table without rows.

    The values are stacked to (column, text) first, so the distinct counts share one shuffle that is
    spread over values.
    """
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    texts = df.select(*[
        (F.to_json(F.struct(c)) if isinstance(t, (T.StructType, T.ArrayType, T.MapType))
         else F.col(c).cast("string")).alias(c)
        for c, t in ((f.name, f.dataType) for f in df.schema.fields)
    ]).unpivot([], df.columns, "column", "text")
    per_value = texts.groupBy("column", "text").agg(F.count(F.lit(1)).alias("n"))
    counted = per_value.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("text").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("text").alias("distinct_values"),
    )
    names = df.sparkSession.createDataFrame(types, "column string, type string")
    return names.join(counted, "column", "left").fillna(0, ["n", "non_null", "distinct_values"])


def unique_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column as rows (column, value)."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column", "value").distinct()


def profile(df: DataFrame, numeric: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Rows (column, statistic, value): null counts, distinct counts and numeric summaries."""
    counts = table_profile(df)
    counts = counts.select(
        "column",
        F.col("n").cast("double").alias("rows"),
        (F.col("n") - F.col("non_null")).cast("double").alias("nulls"),
        F.col("distinct_values").cast("double").alias("distinct_values"),
    ).unpivot(["column"], ["rows", "nulls", "distinct_values"], "statistic", "value")
    summary = describe(df, numeric, buckets).drop("n")
    names = [c for c in summary.columns if c != "column"]
    return counts.unionByName(summary.unpivot(["column"], names, "statistic", "value"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every unordered column pair as rows (x, y, r); nulls pairwise.

    One aggregation without shuffle of rows.
    """
    pairs = list(combinations(columns, 2))
    exprs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}\x1f{b}") for a, b in pairs]
    wide = df.agg(*exprs)
    both = F.split("pair", "\x1f")
    return wide.unpivot([], wide.columns, "pair", "r").select(
        both[0].alias("x"), both[1].alias("y"), "r"
    )


def histogram(
    df: DataFrame, column: str, bins: int = 10, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows (bin, lower, upper, n) of all equal-width bins, empty ones with 0; the top edge belongs to the last bin.

    Without limits and without values there are no edges and no rows; a column with one value has one bin of no width.
    """
    x = F.col(column).cast("double")
    values = df.where(x.isNotNull()).select(x.alias("x"))
    if low is None or high is None:
        edge = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo IS NOT NULL")
        lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
        values = values.withColumn("lo", lo).withColumn("hi", hi)
    else:
        edge = df.sparkSession.createDataFrame([(float(low), float(high))], "lo double, hi double")
        values = values.where(F.col("x").between(low, high)).withColumns(
            {"lo": F.lit(float(low)), "hi": F.lit(float(high))}
        )
    width = (F.col("hi") - F.col("lo")) / bins
    last = F.when(F.col("hi") > F.col("lo"), F.lit(bins - 1)).otherwise(F.lit(0))
    every = edge.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    # A column with one value has zero width and one bin.
    place = F.coalesce(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(0))
    number = F.least(place, F.lit(bins - 1)).cast("int")
    filled = values.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def predicate_share(df: DataFrame, **predicates: Column) -> DataFrame:
    """Rows (predicate, n, share): how many rows meet each condition, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(p).alias(k) for k, p in predicates.items()]
    )
    return counted.unpivot(["__n"], list(predicates), "predicate", "n").select(
        "predicate", "n", F.try_divide("n", "__n").alias("share")
    )


def pivot_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: total, n, mean and share of the grand total."""
    rows = df.where(F.col(key).isNotNull())
    grand = rows.agg(F.sum(value)).scalar()
    return (
        rows.groupBy(key)
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean"))
        .withColumn("share", F.try_divide(F.col("total"), grand))
    )


def grand_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in columns])


def group_mean(df: DataFrame, key: str, value: str, keep: Column | None = None) -> DataFrame:
    """Mean per key over the rows that pass ``keep``."""
    rows = df if keep is None else df.where(keep)
    return rows.groupBy(key).agg(F.avg(value).alias("mean"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
