"""Row and column preparation: filters, fills, remaps, group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.statistics import number_from_md5
from milepost.operators.ordered import exact_percentiles, join_null_safe
from milepost.operators.profile import melt
from milepost.operators.skew import lookup_join


def keep_between(df: DataFrame, **limits: tuple[float | None, float | None]) -> DataFrame:
    """Keep rows whose columns lie in closed ranges; ``None`` leaves a side open."""
    for name, (low, high) in limits.items():
        if low is not None:
            df = df.where(F.col(name) >= F.lit(low))
        if high is not None:
            df = df.where(F.col(name) <= F.lit(high))
    return df


def drop_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Drop rows equal to ``value``; nulls stay."""
    return df.where(F.col(column).isNull() | (F.col(column) != F.lit(value)))


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def fill_text_nulls(df: DataFrame, marker: str) -> DataFrame:
    """Whole-row fill; only text columns can take a text marker."""
    return df.fillna(marker)


def sample_rows(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` random rows, the same ones for the same seed; a top-n, not a full sort."""
    return (
        df.withColumn("__r", number_from_md5(F.lit(seed), F.col(key)))
        .orderBy("__r", key)
        .limit(n)
        .drop("__r")
    )


def group_modes(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Most frequent non-null value of each column per key group; the lowest wins a tie.

    Values are counted first, spread over (group, value), so a crowded group arrives at its final
    task as one row per value and task. Every value keeps its type: columns of one type share a column, the others
    are null, so a tie is decided as it would be for the column alone.
    """
    kinds = dict(df.dtypes)
    places = {kind: f"__v{i}" for i, kind in enumerate(sorted({kinds[c] for c in columns}))}
    rows = F.array(*[
        F.struct(F.lit(c), F.struct(*[
            (F.col(c) if kinds[c] == kind else F.lit(None).cast(kind)).alias(place) for kind, place in places.items()
        ])) for c in columns
    ])
    long = df.select(*keys, F.inline(rows).alias("__column", "__value"))
    held = F.coalesce(*[F.col(f"__value.{p}").cast("string") for p in places.values()])
    counts = (
        long.where(held.isNotNull())
        .groupBy(*keys, "__column", "__value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lowest = F.min(F.struct((-F.col("n")).alias("n"), F.col("__value").alias("value")))
    best = counts.groupBy(*keys, "__column").agg(lowest.alias("best"))
    return best.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__column") == c, F.col(f"best.value.{places[kinds[c]]}"))).alias(c) for c in columns
    ])


def group_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Exact median of each column per key group."""
    long = melt(df, columns, keys, "__column")
    found = exact_percentiles(long, "value", [0.5], [*keys, "__column"])
    return found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__column") == c, F.col("percentile"))).alias(c) for c in columns
    ])


def impute_by_group(
    df: DataFrame,
    how: Mapping[str, str],
    keys: Sequence[str],
    missing: Mapping[str, Column] | None = None,
    overrides: Mapping[str, Sequence[tuple[Column, float]]] | None = None,
    whole_numbers: bool = False,
) -> DataFrame:
    """Replace missing values by a statistic of their key group; all columns in one join.

    ``how`` maps each column to ``mode`` or ``median``. A value is missing when it is null, or when
    ``missing[column]`` holds. Null keys match null keys. ``overrides[column]`` lists (condition on
    the keys, value) that replace a group statistic. ``whole_numbers`` cuts medians to integers.
    """
    missing, overrides = dict(missing or {}), dict(overrides or {})
    stats = None
    for kind, compute in (("mode", group_modes), ("median", group_medians)):
        chosen = [c for c, h in how.items() if h == kind]
        if chosen:
            part = compute(df, chosen, keys)
            stats = part if stats is None else join_null_safe(stats, part, keys, "full")
    for c, kind in how.items():
        value = F.col(c)
        if kind == "median" and whole_numbers:
            value = value.cast("int")
        for condition, replacement in overrides.get(c, ()):
            value = F.when(condition, F.lit(replacement)).otherwise(value)
        stats = stats.withColumn(c, value)
    stats = stats.withColumnsRenamed({c: f"__stat_{c}" for c in how})
    joined = lookup_join(df, stats, keys, "left", null_safe=True)
    kinds = dict(df.dtypes)
    filled = {
        c: F.when(
            missing.get(c, F.col(c).isNull()), F.col(f"__stat_{c}").cast(kinds[c])
        ).otherwise(F.col(c))
        for c in how
    }
    return joined.withColumns(filled).select(*df.columns)


def attach_group_statistic(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left merge of a per-group frame on the keys; null keys match null keys."""
    return lookup_join(df, stats, keys, "left", null_safe=True)


def full_outer(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of frames with one row per key; the key is coalesced."""
    first, *rest = frames
    for frame in rest:
        first = first.join(frame, key, "full")
    return first
