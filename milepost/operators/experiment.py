"""Cohort comparison: roll-ups, change, t-test, bootstrap interval."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.statistics import poisson_counts, t_p_value, uniforms

#: Users and replicates whose weights a task draws at a time.
BOOTSTRAP_ROWS, BOOTSTRAP_REPLICATES = 2048, 256


def user_rollup(
    daily: DataFrame, user: str, cohort: str, sums: Sequence[str], counts: Sequence[str] = ()
) -> DataFrame:
    """One row per user and cohort: counts of some columns, sums of the others."""
    return daily.groupBy(user, cohort).agg(
        *[F.count(c).alias(c) for c in counts], *[F.sum(c).alias(c) for c in sums]
    )


def cohort_totals(users: DataFrame, cohort: str, metrics: Sequence[str]) -> DataFrame:
    return users.groupBy(cohort).agg(*[F.sum(m).alias(m) for m in metrics])


def cohort_moments(
    users: DataFrame, cohort: str, metrics: Sequence[str], a: object, b: object
) -> DataFrame:
    """One row per metric with n, mean, sample variance and total of cohorts ``a`` and ``b``.

    All metrics share one pass that leaves two rows per task; only those are stacked.
    """
    def summary(metric: str) -> Column:
        x = F.col(metric).cast("double")
        return F.struct(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.var_samp(x).alias("var"),
            F.sum(x).alias("total"),
        ).alias(metric)

    wide = users.where(F.col(cohort).isin(a, b)).groupBy(cohort).agg(*[summary(m) for m in metrics])
    per = wide.unpivot([cohort], list(metrics), "metric", "s")
    side = {"a": F.col(cohort) == F.lit(a), "b": F.col(cohort) == F.lit(b)}
    return per.groupBy("metric").agg(*[
        F.max(F.when(cond, F.col(f"s.{c}"))).alias(f"{c}_{s}")
        for s, cond in side.items()
        for c in ("n", "mean", "var", "total")
    ])


def t_statistics(moments: DataFrame) -> DataFrame:
    """Pooled-variance two-sample t: adds ``t`` and ``df``; null where a cohort is too small."""
    df = F.col("n_a") + F.col("n_b") - 2
    spread = F.coalesce((F.col("n_a") - 1) * F.col("var_a"), F.lit(0.0)) + F.coalesce(
        (F.col("n_b") - 1) * F.col("var_b"), F.lit(0.0)
    )
    pooled = F.try_divide(spread, df)
    error = F.sqrt(pooled * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    return moments.withColumn("df", df).withColumn(
        "t", F.try_divide(F.col("mean_a") - F.col("mean_b"), error)
    )


def t_test(
    users: DataFrame, cohort: str, metrics: Sequence[str], a: object, b: object, alpha: float = 0.05
) -> DataFrame:
    """Rows (metric, mean_a, mean_b, t, df, p_value, significant)."""
    tested = t_statistics(cohort_moments(users, cohort, metrics, a, b)).withColumn(
        "p_value", t_p_value(F.col("t"), F.col("df").cast("double"))
    )
    return tested.select(
        "metric", "mean_a", "mean_b", "t", "df", "p_value",
        (F.col("p_value") < F.lit(alpha)).alias("significant"),
    )


def signed_change(a: Column, b: Column) -> Column:
    """Change from a to b in percent; null where a is zero."""
    return F.round(F.try_divide(b - a, a) * 100, 2)


def larger_by_smaller(a: Column, b: Column) -> Column:
    """Larger over smaller in whole percent minus 100; the larger value itself where b is zero."""
    larger, smaller = F.greatest(a, b), F.least(a, b)
    return F.when(b == 0, larger).otherwise(F.rint(F.try_divide(larger, smaller) * 100) - 100)


def bootstrap_differences(
    users: DataFrame,
    user: str,
    cohort: str,
    metric: str,
    a: object,
    b: object,
    replicates: int,
    weights: str = "hash",
) -> DataFrame:
    """Rows (replicate, difference): mean of b minus mean of a under Poisson(1) resampling, replicates from 1.

    A weight depends only on (user, replicate), so any task can be retried. A task adds the weights of its rows to two
    vectors of replicate sums per cohort, a block of rows and replicates at a time: rows are never multiplied by
    replicates, and one row per replicate leaves each task. ``weights`` is ``hash``, or ``md5`` for numbers that any
    engine can give (md5 of ``user|replicate``).
    """
    draw, counted = uniforms(weights), poisson_counts()
    rows_at_once, replicates_at_once = BOOTSTRAP_ROWS, BOOTSTRAP_REPLICATES
    seed = F.xxhash64(user) if weights == "hash" else F.col(user).cast("string")
    rows = users.where(F.col(cohort).isin(a, b) & F.col(metric).isNotNull()).select(
        seed.alias("seed"), (F.col(cohort) == F.lit(b)).alias("in_b"), F.col(metric).cast("double").alias("x")
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        wx, w = np.zeros((2, replicates)), np.zeros((2, replicates))
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                seeds, in_b, x = (c.to_numpy(zero_copy_only=False) for c in part.columns)
                for first in range(0, replicates, replicates_at_once):
                    numbers = np.arange(first, min(first + replicates_at_once, replicates))
                    drawn = counted(draw(seeds, numbers + 1))
                    for side, own in enumerate((~in_b.astype(bool), in_b.astype(bool))):
                        wx[side, numbers] += x[own] @ drawn[own]
                        w[side, numbers] += drawn[own].sum(axis=0)
        columns = [np.arange(1, replicates + 1), wx[0], w[0], wx[1], w[1]]
        names = ["replicate", "wx_a", "w_a", "wx_b", "w_b"]
        kinds = [pa.int32(), *[pa.float64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    # Drawing is the work, and users are narrow: without this a small roll-up would meet in one task.
    session = users.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    sums = rows.repartition(tasks, "seed").mapInArrow(run, "replicate int, wx_a double, w_a double, wx_b double, w_b double")
    mean = {s: F.try_divide(F.sum(f"wx_{s}"), F.sum(f"w_{s}")) for s in "ab"}
    return sums.groupBy("replicate").agg((mean["b"] - mean["a"]).alias("difference"))


def bootstrap_interval(differences: DataFrame, level: float = 0.95) -> DataFrame:
    """One row (ci_low, ci_high) of the replicate differences."""
    tail = (1 - level) / 2
    # One row per replicate: the number of replicates is an argument, not data.
    edges = F.percentile("difference", [tail, 1 - tail])
    return differences.agg(edges.alias("e")).select(
        F.col("e")[0].alias("ci_low"), F.col("e")[1].alias("ci_high")
    )


def ab_report(
    daily: DataFrame,
    user: str,
    cohort: str,
    sums: Sequence[str],
    a: object,
    b: object,
    counts: Sequence[str] = (),
    alpha: float = 0.05,
    bootstrap: Mapping[str, int] | None = None,
    weights: str = "hash",
) -> DataFrame:
    """Rows (metric, a, b, change_pct, ratio_pct, p_value, significant, ci_low, ci_high).

    ``bootstrap`` maps metrics to a number of replicates; other metrics have no interval.
    """
    metrics = [*counts, *sums]
    users = user_rollup(daily, user, cohort, sums, counts)
    moments = t_statistics(cohort_moments(users, cohort, metrics, a, b)).withColumn(
        "p_value", t_p_value(F.col("t"), F.col("df").cast("double"))
    )
    report = moments.select(
        "metric",
        F.col("total_a").alias("a"),
        F.col("total_b").alias("b"),
        signed_change(F.col("total_a"), F.col("total_b")).alias("change_pct"),
        larger_by_smaller(F.col("total_a"), F.col("total_b")).alias("ratio_pct"),
        "p_value",
        (F.col("p_value") < F.lit(alpha)).alias("significant"),
    )
    interval = F.lit(None).cast("struct<ci_low: double, ci_high: double>")
    for metric, replicates in (bootstrap or {}).items():
        draws = bootstrap_differences(users, user, cohort, metric, a, b, replicates, weights)
        found = bootstrap_interval(draws, 1 - alpha).select(F.struct("ci_low", "ci_high")).scalar()
        interval = F.when(F.col("metric") == metric, found).otherwise(interval)
    return report.withColumn("ci", interval).select("*", "ci.ci_low", "ci.ci_high").drop("ci")
