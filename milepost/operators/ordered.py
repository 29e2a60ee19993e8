"""Exact order statistics without sorting a whole group, or the whole table, in one task.

Rows are counted per (group, value) first and these counts are written out, so the input is read once
however often they are used. The values are cut into quantile buckets; there are as many buckets as the
counts ask for, so a group that owns most of the table is still spread over most of them. The edges only
decide where the work happens, so a KLL sketch taken with the count serves for them; ranks and sums count every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from milepost.operators.scratch import written

#: Counted values that one bucket should hold, and size of the sketch that cuts them (ranks within 0.1 %).
BUCKET_ROWS = 500_000
SKETCH_K = 4096


def with_bucket(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """Add ``bucket``, a non-decreasing function of the numeric column ``value``.

    ``df`` is read twice: pass a written table. Without ``buckets`` its rows decide their number. Rows are counted and
    sketched in one pass; the edges are a plain list read from the sketch, so all uses of the frame see the same cut.
    """
    number = F.col(value).cast("double")
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(number.isNotNull() & ~F.isnan(number)).alias("known"),
        F.kll_sketch_agg_double(number, SKETCH_K).alias("sketch"),
    ).first()
    buckets = buckets or max(8, -(-found["rows"] // BUCKET_ROWS))
    edges: list[float] = []
    if found["known"] and buckets > 1:
        shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        held = df.sparkSession.createDataFrame([(found["sketch"],)], "sketch binary")
        cuts = held.select(F.kll_sketch_get_quantile_double("sketch", shares).alias("edges")).first()["edges"]
        edges = sorted({e for e in cuts if e == e and abs(e) != float("inf")})
    inf = float("inf")
    cut = Bucketizer(
        splits=[-inf, *(edges or [0.0]), inf],
        inputCol="__number",
        outputCol="bucket",
        handleInvalid="keep",
    )
    return (
        cut.transform(df.withColumn("__number", number))
        .withColumn("bucket", F.col("bucket").cast("int"))
        .drop("__number")
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (keys, order) with each summed column and its running total ``cum_<column>``.

    Rows are summed per value before anything is ordered.
    """
    keys = list(keys)
    summed = df.groupBy(*keys, order).agg(*[F.sum(c).alias(c) for c in sums])
    per_value = with_bucket(written(summed, "sums"), order, buckets)
    direction = F.desc if descending else F.asc
    before = W.partitionBy(*keys).orderBy(direction("bucket")).rowsBetween(
        W.unboundedPreceding, -1
    )
    offsets = per_value.groupBy(*keys, "bucket").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    offsets = offsets.select(
        *keys,
        "bucket",
        *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sums],
    )
    within = W.partitionBy(*keys, "bucket").orderBy(direction(order)).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    joined = join_null_safe(per_value, offsets, [*keys, "bucket"])
    return joined.select(
        *keys,
        order,
        *sums,
        *[(F.sum(c).over(within) + F.col(f"__off_{c}")).alias(f"cum_{c}") for c in sums],
    )


def exact_percentiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Linear-interpolated percentiles: rows (keys, share, percentile, n). Nulls are left out.

    Values are ranked in their own type; only the interpolation is in doubles. Only the buckets that hold a wanted rank
    are sorted.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"))
    counted = rows.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    per_value = with_bucket(written(counted, "value-counts"), "v", buckets)
    whole = W.partitionBy(*keys)
    before = whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        per_value.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("in_bucket"))
        .withColumn("off", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
        .withColumn("total", F.sum("in_bucket").over(whole))
    )
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    position = F.col("share") * (F.col("total") - 1)
    ranked = totals.withColumn("share", wanted).select(
        *keys,
        "bucket",
        "off",
        "in_bucket",
        "total",
        "share",
        position.alias("pos"),
    )
    low, high = F.floor("pos"), F.ceil("pos")
    inside = lambda r: (r >= F.col("off")) & (r < F.col("off") + F.col("in_bucket"))
    targets = ranked.where(inside(low) | inside(high))
    needed = targets.select(*keys, "bucket").distinct()
    running = W.partitionBy(*keys, "bucket").orderBy("v")
    sorted_values = join_null_safe(per_value, needed, [*keys, "bucket"]).withColumn(
        "cum", F.sum("n").over(running)
    )
    found = join_null_safe(sorted_values, targets, [*keys, "bucket"])
    reached = F.col("off") + F.col("cum")
    picked = (
        found.groupBy(*keys, "share", "pos", "total")
        .agg(
            F.min(F.when(inside(low) & (reached > low), F.col("v"))).alias("low"),
            F.min(F.when(inside(high) & (reached > high), F.col("v"))).alias("high"),
        )
    )
    return picked.select(
        *keys,
        "share",
        (
            F.col("low").cast("double")
            + (F.col("high").cast("double") - F.col("low").cast("double")) * (F.col("pos") - F.floor("pos"))
        ).alias("percentile"),
        F.col("total").alias("n"),
    )


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on equally named columns where null matches null; the keys are coalesced."""
    renamed = right.withColumnsRenamed({k: f"__j_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__j_{k}"])
    joined = left.join(renamed, condition, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"__j_{k}") for k in keys})
    return joined.drop(*[f"__j_{k}" for k in keys])
