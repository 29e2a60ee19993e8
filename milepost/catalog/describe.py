"""Table descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from milepost.catalog import derive
from milepost.catalog.registry import load, query, rounded
from milepost.operators import profile
from milepost.operators.ordered import exact_percentiles

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(column: str) -> str:
    q = ", ".join(
        f"round(quantile_cont({column}, {s}), 6) + 0.0e0 AS q{int(s * 100)}" for s in (0.25, 0.5, 0.75)
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS n, round(avg({column}), 4) + 0.0e0 AS mean,
      round(stddev_samp({column}), 4) + 0.0e0 AS std, round(min({column}), 4) + 0.0e0 AS min,
      round(max({column}), 4) + 0.0e0 AS max, {q} FROM lineitem"""


@query("describe", " UNION ALL ".join(_describe_sql(c) for c in _NUMBERS))
def describe(spark, sf_dir):
    out = profile.describe(load(spark, sf_dir, "lineitem"), _NUMBERS)
    return rounded(rounded(out, ["mean", "std", "min", "max"]), ["q25", "q50", "q75"], 6)


@query(
    "percentiles",
    """SELECT l_returnflag, s AS share, round(p, 6) + 0.0e0 AS percentile, n FROM (
      SELECT l_returnflag, count(*) AS n, unnest([0.01e0, 0.025e0, 0.975e0, 0.99e0]) AS s,
        unnest(quantile_cont(l_extendedprice, [0.01, 0.025, 0.975, 0.99])) AS p
      FROM lineitem GROUP BY l_returnflag)""",
)
def percentiles(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    shares = [0.01, 0.025, 0.975, 0.99]
    return rounded(
        exact_percentiles(items, "l_extendedprice", shares, ["l_returnflag"]), ["percentile"], 6
    )


@query(
    "global_median",
    """SELECT 0.5e0 AS share, round(quantile_cont(o_totalprice, 0.5), 6) + 0.0e0 AS percentile,
      count(*) AS n FROM orders""",
)
def global_median(spark, sf_dir):
    return rounded(exact_percentiles(load(spark, sf_dir, "orders"), "o_totalprice", [0.5]), ["percentile"], 6)


@query(
    "value_counts",
    "SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type",
)
def value_counts(spark, sf_dir):
    return profile.value_counts(load(spark, sf_dir, "part"), "p_type")


@query("value_counts_by_value", "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity ORDER BY l_quantity")
def value_counts_by_value(spark, sf_dir):
    return profile.value_counts(load(spark, sf_dir, "lineitem"), "l_quantity", by_value=True)


@query(
    "null_profile",
    f"""WITH {derive.PARTS_SQL}
    SELECT 'p_size' AS "column", count(*) FILTER (WHERE p_size IS NULL) AS nulls,
      round(avg(CASE WHEN p_size IS NULL THEN 1.0e0 ELSE 0 END), 6) + 0.0e0 AS null_share FROM parts
    UNION ALL SELECT 'p_type', count(*) FILTER (WHERE p_type IS NULL),
      round(avg(CASE WHEN p_type IS NULL THEN 1.0e0 ELSE 0 END), 6) + 0.0e0 FROM parts
    UNION ALL SELECT 'p_brand', count(*) FILTER (WHERE p_brand IS NULL), 0.0e0 FROM parts""",
)
def null_profile(spark, sf_dir):
    out = profile.null_profile(derive.gappy_parts(spark, sf_dir), ["p_size", "p_type", "p_brand"])
    return rounded(out, ["null_share"], 6)


@query(
    "dup_count",
    """SELECT 'row' AS scope, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY ALL l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
    UNION ALL SELECT 'key', CAST(sum(n - 1) AS BIGINT) FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""".replace("GROUP BY ALL ", "GROUP BY "),
)
def dup_count(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    whole = profile.duplicate_count(items).select(F.lit("row").alias("scope"), "duplicates")
    keys = profile.duplicate_count(items, ["l_orderkey", "l_linenumber"])
    return whole.unionByName(keys.select(F.lit("key").alias("scope"), "duplicates"))


@query(
    "histogram",
    """WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 4) + 0.0e0 AS lower,
      round(lo + (b.bin + 1) * w, 4) + 0.0e0 AS upper, count(f.bin) AS n
    FROM range(20) b(bin) CROSS JOIN e
      LEFT JOIN (SELECT least(floor((o_totalprice - lo) / w), 19) AS bin FROM orders, e) f ON f.bin = b.bin
    GROUP BY b.bin, lo, w""",
)
def histogram(spark, sf_dir):
    out = profile.histogram(load(spark, sf_dir, "orders"), "o_totalprice", bins=20)
    return rounded(out, ["lower", "upper"])


@query(
    "histogram_in_range",
    """SELECT CAST(b.bin AS INTEGER) AS bin, 4.0e0 * b.bin AS lower, 4.0e0 * (b.bin + 1) AS upper, count(f.bin) AS n
    FROM range(10) b(bin)
      LEFT JOIN (SELECT least(floor(l_quantity / 4), 9) AS bin FROM lineitem WHERE l_quantity BETWEEN 0 AND 40) f
      ON f.bin = b.bin
    GROUP BY b.bin""",
)
def histogram_in_range(spark, sf_dir):
    return profile.histogram(load(spark, sf_dir, "lineitem"), "l_quantity", bins=10, low=0, high=40)


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) + 0.0e0 AS r FROM lineitem"
        for i, a in enumerate(_NUMBERS)
        for b in _NUMBERS[i + 1 :]
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(load(spark, sf_dir, "lineitem"), _NUMBERS), ["r"], 6)


_PART_TYPES = {"p_partkey": "bigint", "p_brand": "string", "p_size": "int", "p_type": "string", "price": "double"}


@query(
    "table_profile",
    f"WITH {derive.PARTS_SQL} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) AS n, count({c}) AS non_null,
        count(DISTINCT {c}) AS distinct_values FROM parts""" for c, t in _PART_TYPES.items()
    ),
)
def table_profile(spark, sf_dir):
    return profile.table_profile(derive.gappy_parts(spark, sf_dir))


@query(
    "profile",
    f"""WITH {derive.PARTS_SQL},
    c AS (""" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) AS DOUBLE) AS rows, CAST(count(*) - count({c}) AS DOUBLE) AS nulls,
        CAST(count(DISTINCT {c}) AS DOUBLE) AS distinct_values FROM parts""" for c in _PART_TYPES
    ) + """)
    SELECT "column", 'rows' AS statistic, rows AS value FROM c UNION ALL SELECT "column", 'nulls', nulls FROM c
    UNION ALL SELECT "column", 'distinct_values', distinct_values FROM c
    """ + "".join(
        f"UNION ALL SELECT 'price', '{name}', round({expr}, 4) + 0.0e0 FROM parts "
        for name, expr in {
            "mean": "avg(price)", "std": "stddev_samp(price)", "min": "min(price)", "max": "max(price)",
            "q25": "quantile_cont(price, 0.25)", "q50": "quantile_cont(price, 0.5)",
            "q75": "quantile_cont(price, 0.75)",
        }.items()
    ),
)
def whole_profile(spark, sf_dir):
    return rounded(profile.profile(derive.gappy_parts(spark, sf_dir), ["price"]), ["value"])


@query(
    "unique_values",
    """SELECT 'p_type' AS "column", p_type AS value FROM (SELECT DISTINCT p_type FROM part)
    UNION ALL SELECT 'p_brand', p_brand FROM (SELECT DISTINCT p_brand FROM part)""",
)
def unique_values(spark, sf_dir):
    return profile.unique_values(load(spark, sf_dir, "part"), ["p_type", "p_brand"])


@query(
    "predicate_share",
    f"""WITH {derive.PARTS_SQL}
    SELECT 'free' AS predicate, count(*) FILTER (WHERE price = 0) AS n,
      round(avg(CASE WHEN price = 0 THEN 1.0e0 ELSE 0 END), 6) + 0.0e0 AS share FROM parts
    UNION ALL SELECT 'dear', count(*) FILTER (WHERE price > 1500),
      round(avg(CASE WHEN price > 1500 THEN 1.0e0 ELSE 0 END), 6) + 0.0e0 FROM parts""",
)
def predicate_share(spark, sf_dir):
    out = profile.predicate_share(
        derive.gappy_parts(spark, sf_dir), free=F.col("price") == 0, dear=F.col("price") > 1500
    )
    return rounded(out, ["share"], 6)


@query(
    "month_mean",
    """SELECT CAST(month(l_shipdate) AS INTEGER) AS month, round(avg(l_extendedprice), 3) + 0.0e0 AS mean
    FROM lineitem WHERE month(l_shipdate) <> 1 GROUP BY month(l_shipdate)""",
)
def month_mean(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").withColumn("month", F.month("l_shipdate"))
    return rounded(
        profile.group_mean(items, "month", "l_extendedprice", F.col("month") != 1), ["mean"], 3
    )


@query(
    "grand_totals",
    "SELECT round(sum(l_quantity), 2) + 0.0e0 AS l_quantity, round(sum(l_extendedprice), 2) + 0.0e0 AS l_extendedprice FROM lineitem",
)
def grand_totals(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice"]
    return rounded(profile.grand_totals(load(spark, sf_dir, "lineitem"), columns), columns, 2)
