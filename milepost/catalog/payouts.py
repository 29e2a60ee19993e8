"""Courier payouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.catalog import derive
from milepost.catalog.registry import load, query
from milepost.plans import payouts, warehouse

_DELIVERY_SQL = """d AS (
  SELECT l_suppkey AS courier_id, l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS y,
    CAST(month(l_shipdate) AS INTEGER) AS m,
    CAST(30 + round(l_discount * 200, 0) AS BIGINT) AS rate10,
    CAST(l_extendedprice AS DECIMAL(14,2)) AS amount,
    CAST(round(l_tax * 100, 2) AS DECIMAL(14,2)) AS tip
  FROM lineitem
),
p AS (
  SELECT *, CAST(amount * CASE WHEN rate10 < 40 THEN 0.05 WHEN rate10 < 45 THEN 0.07
      WHEN rate10 <= 49 THEN 0.80 ELSE 0.10 END AS DECIMAL(18,4)) AS part,
    CAST(CASE WHEN rate10 < 40 THEN 100 WHEN rate10 < 45 THEN 150 WHEN rate10 <= 49 THEN 175
      ELSE 200 END AS DECIMAL(18,4)) AS least_pay
  FROM d
),
pay AS (SELECT *, CASE WHEN part > least_pay THEN part ELSE least_pay END AS money FROM p)"""


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals shown as doubles, for the comparison."""
    decimals = [c for c, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


@query(
    "courier_ledger",
    f"""WITH {_DELIVERY_SQL}
    SELECT courier_id, s_name AS courier_name, y AS settlement_year, m AS settlement_month,
      count(*) AS orders_count,
      CAST(CAST(sum(amount) AS DECIMAL(14,2)) AS DOUBLE) AS orders_total_sum,
      CAST((sum(rate10) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS rate_avg,
      CAST(CAST(CAST(sum(amount) AS DECIMAL(20,2)) * 0.25 AS DECIMAL(14,2)) AS DOUBLE) AS order_processing_fee,
      CAST(CAST(sum(money) AS DECIMAL(14,2)) AS DOUBLE) AS courier_order_sum,
      CAST(CAST(sum(tip) AS DECIMAL(14,2)) AS DOUBLE) AS courier_tips_sum,
      CAST(CAST(CAST(sum(tip) + sum(money) AS DECIMAL(20,4)) * 0.95 AS DECIMAL(14,2)) AS DOUBLE) AS courier_reward_sum
    FROM pay JOIN supplier ON s_suppkey = courier_id
    GROUP BY courier_id, s_name, y, m""",
)
def courier_ledger(spark, sf_dir):
    moments = load(spark, sf_dir, "lineitem").select("l_shipdate")
    ledger = payouts.courier_ledger(
        derive.deliveries(spark, sf_dir),
        derive.couriers(spark, sf_dir),
        warehouse.timestamp_dimension(moments, "l_shipdate"),
    )
    return _plain(ledger)


@query(
    "payout_bands",
    f"""WITH {_DELIVERY_SQL}
    SELECT CAST(rate10 AS DOUBLE) / 10 AS rate, count(*) AS n,
      CAST(CAST(sum(money) AS DECIMAL(20,4)) AS DOUBLE) AS money
    FROM pay GROUP BY rate10""",
)
def payout_bands(spark, sf_dir):
    paid = derive.deliveries(spark, sf_dir).withColumn(
        "money", payouts.payout(F.col("sum"), F.col("rate"))
    )
    return _plain(
        paid.groupBy("rate").agg(
            F.count(F.lit(1)).alias("n"), F.sum("money").cast("decimal(20,4)").alias("money")
        )
    )
