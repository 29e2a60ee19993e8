"""Courier payout ledger."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.scalars import larger_of
from milepost.operators.skew import lookup_join


@dataclass(frozen=True)
class Band:
    """Ratings up to ``upper`` (that value included or not) earn ``share`` of the sum, at least
    ``minimum``."""

    upper: Decimal | None
    included: bool
    share: Decimal
    minimum: Decimal


# The written payout bands.
BANDS = (
    Band(Decimal("4.0"), False, Decimal("0.05"), Decimal(100)),
    Band(Decimal("4.5"), False, Decimal("0.07"), Decimal(150)),
    Band(Decimal("4.9"), True, Decimal("0.80"), Decimal(175)),
    Band(None, True, Decimal("0.10"), Decimal(200)),
)
FEE_SHARE = Decimal("0.25")
REWARD_SHARE = Decimal("0.95")


def payout(amount: Column, rate: Column, bands: Sequence[Band] = BANDS) -> Column:
    """Share of the order sum by rating band, or the band's minimum where that is larger.

    The first band that fits applies; a null rating fits none and pays null.
    """
    paid = F.when(rate.isNull(), F.lit(None))
    for band in bands:
        if band.upper is None:
            fits = rate.isNotNull()
        else:
            edge = F.lit(band.upper)
            fits = rate <= edge if band.included else rate < edge
        minimum = F.lit(band.minimum).cast("decimal(14,2)")
        paid = paid.when(fits, larger_of(amount * F.lit(band.share), minimum))
    return paid


def courier_ledger(
    deliveries: DataFrame,
    couriers: DataFrame,
    timestamps: DataFrame,
    bands: Sequence[Band] = BANDS,
) -> DataFrame:
    """Per courier and month: orders, sums, mean rating, fee, tips and reward.

    Deliveries are summed per courier and month before the courier's name is looked up, so the
    second join sees a few rows per courier however many deliveries that courier made.
    """
    dated = lookup_join(
        deliveries.select("order_id", "courier_id", "timestamp_id", "rate", "sum", "tip_sum"),
        timestamps.select(F.col("id").alias("timestamp_id"), "year", "month"),
        ["timestamp_id"],
        "inner",
    )
    summed = (
        dated.withColumn("money", payout(F.col("sum"), F.col("rate"), bands))
        .groupBy("courier_id", "year", "month")
        .agg(
            F.count("order_id").alias("orders_count"),
            F.sum("sum").alias("total"),
            F.sum("rate").alias("rate_total"),
            F.count("rate").alias("rated"),
            F.sum("money").alias("money"),
            F.sum("tip_sum").alias("tips"),
        )
    )
    named = summed.join(
        couriers.select(F.col("id").alias("courier_id"), "courier_name"), "courier_id"
    )
    money = lambda c: c.cast("decimal(14,2)")
    return named.select(
        "courier_id",
        "courier_name",
        F.col("year").cast("int").alias("settlement_year"),
        F.col("month").cast("int").alias("settlement_month"),
        "orders_count",
        money(F.col("total")).alias("orders_total_sum"),
        money(F.try_divide("rate_total", "rated")).alias("rate_avg"),
        money(F.col("total") * F.lit(FEE_SHARE)).alias("order_processing_fee"),
        money(F.col("money")).alias("courier_order_sum"),
        money(F.col("tips")).alias("courier_tips_sum"),
        money((F.col("tips") + F.col("money")) * F.lit(REWARD_SHARE)).alias("courier_reward_sum"),
    )
