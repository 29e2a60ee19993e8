"""Row and column preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from milepost.catalog import derive
from milepost.catalog.registry import load, query, rounded
from milepost.operators import prepare
from milepost.operators.profile import describe_times, time_histogram
from milepost.operators.profile import pivot_share as share_by
from milepost.plans import cars, customers


def _mode_sql(value: str, keys: str, source: str) -> str:
    first_by = ", ".join(f"{k}" for k in keys.split(", "))
    return f"""(SELECT {keys}, {value} AS top FROM (
      SELECT {keys}, {value}, row_number() OVER (PARTITION BY {first_by} ORDER BY count(*) DESC, {value}) AS rn
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn = 1)"""


@query(
    "group_modes",
    f"""WITH {derive.PARTS_SQL}
    SELECT p_brand, p_size, top AS p_type FROM {_mode_sql('p_type', 'p_brand, p_size', 'parts')}""",
)
def group_modes(spark, sf_dir):
    return prepare.group_modes(derive.gappy_parts(spark, sf_dir), ["p_type"], ["p_brand", "p_size"])


@query(
    "group_medians",
    f"""WITH {derive.PARTS_SQL}
    SELECT p_brand, round(quantile_cont(price, 0.5), 4) + 0.0e0 AS price,
      round(quantile_cont(p_size, 0.5), 4) + 0.0e0 AS p_size FROM parts GROUP BY p_brand""",
)
def group_medians(spark, sf_dir):
    out = prepare.group_medians(derive.gappy_parts(spark, sf_dir), ["price", "p_size"], ["p_brand"])
    return rounded(out, ["price", "p_size"])


@query(
    "impute_mode",
    f"""WITH {derive.PARTS_SQL}
    SELECT p_partkey, p.p_brand, p.p_size, coalesce(p_type, top) AS p_type
    FROM parts p LEFT JOIN {_mode_sql('p_type', 'p_brand, p_size', 'parts')} m
      ON p.p_brand = m.p_brand AND p.p_size IS NOT DISTINCT FROM m.p_size""",
)
def impute_mode(spark, sf_dir):
    parts = derive.gappy_parts(spark, sf_dir).drop("price")
    return prepare.impute_by_group(parts, {"p_type": "mode"}, ["p_brand", "p_size"])


@query(
    "impute_median",
    f"""WITH {derive.PARTS_SQL},
    med AS (SELECT p_brand, p_type, trunc(quantile_cont(price, 0.5)) AS med FROM parts GROUP BY p_brand, p_type)
    SELECT p_partkey, CASE WHEN price = 0 THEN CASE WHEN p.p_brand = 'Brand#11' THEN 76.5e0 ELSE med END
      ELSE price END AS price
    FROM parts p LEFT JOIN med ON p.p_brand = med.p_brand AND p.p_type IS NOT DISTINCT FROM med.p_type""",
)
def impute_median(spark, sf_dir):
    out = prepare.impute_by_group(
        derive.gappy_parts(spark, sf_dir),
        {"price": "median"},
        ["p_brand", "p_type"],
        missing={"price": F.col("price") == 0},
        overrides={"price": [(F.col("p_brand") == "Brand#11", 76.5)]},
        whole_numbers=True,
    )
    return out.select("p_partkey", "price")


@query(
    "group_statistic_merge",
    f"""WITH {derive.PARTS_SQL},
    s AS (SELECT p_type, count(*) AS of_type FROM parts GROUP BY p_type)
    SELECT p_partkey, p.p_type, of_type FROM parts p LEFT JOIN s ON p.p_type IS NOT DISTINCT FROM s.p_type""",
)
def group_statistic_merge(spark, sf_dir):
    """Left merge on a key with nulls: null matches null."""
    parts = derive.gappy_parts(spark, sf_dir).select("p_partkey", "p_type")
    counts = parts.groupBy("p_type").agg(F.count(F.lit(1)).alias("of_type"))
    return prepare.attach_group_statistic(parts, counts, ["p_type"])


@query(
    "outlier_filter",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) + 0.0e0 AS total FROM lineitem
    WHERE l_quantity >= 5 AND l_quantity <= 45 AND l_extendedprice <= 50000 AND l_discount <> 0
    GROUP BY l_returnflag""",
)
def outlier_filter(spark, sf_dir):
    items = prepare.drop_value(load(spark, sf_dir, "lineitem"), "l_discount", 0)
    kept = prepare.keep_between(items, l_quantity=(5, 45), l_extendedprice=(None, 50000))
    out = kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("total")
    )
    return rounded(out, ["total"], 2)


@query(
    "sample_rows",
    f"""WITH {derive.PARTS_SQL}
    SELECT p_partkey, p_brand, p_size, price FROM parts WHERE p_type IS NULL
    ORDER BY CAST(('0x' || substr(md5('7|' || p_partkey), 1, 8)) AS BIGINT), p_partkey LIMIT 5""",
)
def sample_rows(spark, sf_dir):
    """Five random rows with a gap, the same ones for the same seed."""
    gaps = derive.gappy_parts(spark, sf_dir).where(F.col("p_type").isNull())
    return prepare.sample_rows(gaps.drop("p_type"), 5, seed=7, key="p_partkey")


@query(
    "first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def first_rows(spark, sf_dir):
    """The few rows of the largest value."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query(
    "column_edits",
    f"""WITH {derive.PARTS_SQL}
    SELECT p_partkey AS key, coalesce(p_type, 'none') AS p_type, coalesce(p_size, 0) AS p_size,
      CAST(NULL AS VARCHAR) AS feedback, 's3' AS load_src, CAST(trunc(price) AS INTEGER) AS price,
      CAST(p_partkey AS VARCHAR) AS key_text
    FROM parts""",
)
def column_edits(spark, sf_dir):
    """Lower-case, drop, rename, fill, cast and constant columns."""
    parts = derive.gappy_parts(spark, sf_dir)
    parts = prepare.lower_case_columns(parts.toDF(*[c.upper() for c in parts.columns]))
    return (
        parts.drop("p_brand")
        .withColumnRenamed("p_partkey", "key")
        .fillna({"p_type": "none", "p_size": 0})
        .withColumns(
            {
                "feedback": F.lit(None).cast("string"),
                "load_src": F.lit("s3"),
                "price": F.col("price").cast("int"),
                "key_text": F.col("key").cast("string"),
            }
        )
    )


@query(
    "contract_features",
    f"""WITH {derive.TELECOM_SQL}
    SELECT customerID, Type, PaperlessBilling, PaymentMethod, MonthlyCharges, TotalCharges,
      dayname(begin_day) AS Day, CAST(month(begin_day) AS INTEGER) AS Month, CAST(year(begin_day) AS INTEGER) AS Year,
      CAST(coalesce(end_day, DATE '2020-02-01') - begin_day AS INTEGER) AS DaysInside,
      CASE WHEN end_day IS NULL THEN 1 ELSE 0 END AS is_active
    FROM contract""",
)
def contract_features(spark, sf_dir):
    return customers.contract_features(derive.telecom(spark, sf_dir)[0])


@query("customer_view", f"WITH {derive.TELECOM_SQL} SELECT * FROM view_")
def customer_view(spark, sf_dir):
    return customers.customer_view(*derive.telecom(spark, sf_dir))


@query(
    "without_any_service",
    f"""WITH {derive.TELECOM_SQL}
    SELECT count(*) FILTER (WHERE InternetService = 'No' AND MultipleLines = 'No') AS without_any_service FROM view_""",
)
def without_any_service(spark, sf_dir):
    return customers.without_any_service(customers.customer_view(*derive.telecom(spark, sf_dir)))


@query(
    "pivot_share",
    f"""WITH {derive.TELECOM_SQL},
    k AS (SELECT * FROM view_ WHERE InternetService <> 'No')
    SELECT InternetService, round(sum(MonthlyCharges), 2) + 0.0e0 AS total, count(MonthlyCharges) AS n,
      round(avg(MonthlyCharges), 4) + 0.0e0 AS mean,
      round(sum(MonthlyCharges) / (SELECT sum(MonthlyCharges) FROM k), 6) + 0.0e0 AS share
    FROM k GROUP BY InternetService""",
)
def pivot_share(spark, sf_dir):
    view = customers.customer_view(*derive.telecom(spark, sf_dir))
    out = share_by(customers.with_service(view, "InternetService"), "InternetService", "MonthlyCharges")
    return rounded(rounded(rounded(out, ["total"], 2), ["mean"], 4), ["share"], 6)


@query(
    "pivot_share_orders",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) + 0.0e0 AS total, count(*) AS n,
      round(avg(o_totalprice), 3) + 0.0e0 AS mean,
      round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 6) + 0.0e0 AS share
    FROM orders GROUP BY o_orderpriority""",
)
def pivot_share_orders(spark, sf_dir):
    out = share_by(load(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(rounded(rounded(out, ["total"], 2), ["mean"], 3), ["share"], 6)


ADVERT_SQL = f"""raw AS (
  SELECT p_partkey AS advert_id, p_brand AS brand,
    CASE WHEN p_partkey % 31 = 0 THEN 0 ELSE CAST(floor(p_retailprice) AS INTEGER) END AS price,
    CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS vehicletype,
    CAST(1970 + p_partkey % 50 AS INTEGER) AS registrationyear,
    CASE WHEN p_partkey % 9 <> 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'auto' ELSE 'manual' END END AS gearbox,
    CASE WHEN p_partkey % 11 = 0 THEN 0.0e0 ELSE CAST(40 + (p_partkey * 37) % 1000 AS DOUBLE) END AS power,
    CASE WHEN p_partkey % 5 <> 0 THEN 'm' || (p_size % 4) END AS model,
    CAST(p_size * 3000 AS INTEGER) AS kilometer, CAST(p_partkey % 13 AS INTEGER) AS registrationmonth,
    CASE WHEN p_partkey % 10 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'gasoline' ELSE 'petrol' END END AS fueltype,
    CASE WHEN p_partkey % 6 <> 0 THEN CASE WHEN p_partkey % 8 = 1 THEN 'yes' ELSE 'no' END ELSE 'no' END AS notrepaired
  FROM part
),
kept AS (SELECT * FROM raw WHERE price <> 0 AND registrationyear BETWEEN 1980 AND 2016),
named AS (SELECT k.* REPLACE (coalesce(model, top) AS model)
  FROM kept k LEFT JOIN {_mode_sql('model', 'brand', 'kept')} m ON k.brand = m.brand),
sound AS (SELECT * FROM named WHERE power < 1000),
med AS (SELECT brand, model, trunc(quantile_cont(power, 0.5)) AS med FROM sound GROUP BY brand, model)"""


@query(
    "car_adverts",
    f"""WITH {ADVERT_SQL}
    SELECT n.* REPLACE (coalesce(vehicletype, v.top) AS vehicletype, coalesce(gearbox, g.top) AS gearbox,
      coalesce(fueltype, f.top) AS fueltype, CASE WHEN power = 0 THEN med ELSE power END AS power)
    FROM sound n
      LEFT JOIN {_mode_sql('vehicletype', 'brand, model', 'named')} v ON n.brand = v.brand AND n.model = v.model
      LEFT JOIN {_mode_sql('gearbox', 'brand, model', 'named')} g ON n.brand = g.brand AND n.model = g.model
      LEFT JOIN {_mode_sql('fueltype', 'brand, model', 'sound')} f ON n.brand = f.brand AND n.model = f.model
      LEFT JOIN med ON n.brand = med.brand AND n.model = med.model""",
)
def car_adverts(spark, sf_dir):
    return cars.clean_adverts(derive.adverts(spark, sf_dir))


_DATES_SQL = """d AS (
  SELECT p_partkey AS k,
    TIMESTAMP '2016-03-05' + to_days(CAST(p_partkey % 30 AS INTEGER)) + to_seconds(p_partkey % 86400) AS datecrawled,
    CASE WHEN p_partkey % 50 <> 0 THEN TIMESTAMP '2016-03-05' + to_days(CAST(p_partkey % 20 AS INTEGER)) END AS datecreated,
    TIMESTAMP '2016-03-05' + to_days(CAST(p_partkey % 30 + 3 AS INTEGER)) + to_seconds(p_partkey % 3600) AS lastseen
  FROM part)"""


@query(
    "advert_dates",
    f"WITH {_DATES_SQL} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(DISTINCT CAST({c} AS DATE)) AS days, min({c}) AS first, max({c}) AS last FROM d"""
        for c in cars.DATE_COLUMNS
    ),
)
def advert_dates(spark, sf_dir):
    """Summary of the date columns before they are dropped; unreadable dates are null."""
    out = describe_times(cars.advert_dates(derive.adverts(spark, sf_dir)), cars.DATE_COLUMNS).drop("mean")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


@query(
    "advert_date_histogram",
    f"""WITH {_DATES_SQL}, e AS (SELECT min(datecrawled) AS lo, epoch(max(datecrawled)) - epoch(min(datecrawled)) AS w FROM d)
    SELECT CAST(b.bin AS INTEGER) AS bin, count(f.bin) AS n FROM range(6) b(bin) LEFT JOIN (
      SELECT least(floor((epoch(datecrawled) - epoch(lo)) / (w / 6)), 5) AS bin FROM d, e) f ON f.bin = b.bin GROUP BY b.bin""",
)
def advert_date_histogram(spark, sf_dir):
    return time_histogram(cars.advert_dates(derive.adverts(spark, sf_dir)), "datecrawled", 6).select("bin", "n")
