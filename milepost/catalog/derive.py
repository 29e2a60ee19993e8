"""Job inputs derived from the driver tables, by rules that both engines evaluate alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.catalog.registry import load
from milepost.functions.scalars import moment_id

# The city dimension of the queries.
CITY_ROWS = (
    ("Sydney", -33.8650, 151.2094),
    ("Melbourne", -37.8136, 144.9631),
    ("Brisbane", -27.4678, 153.0281),
    ("Perth", -31.9522, 115.8589),
    ("Adelaide", -34.9289, 138.6011),
    ("Gold Coast", -28.0167, 153.4000),
    ("Darwin", -12.4381, 130.8411),
    ("Hobart", -42.8806, 147.3250),
)

CITY_SQL = "city(idx, city, lat, lng) AS (VALUES " + ", ".join(
    f"({i}, '{c}', {lat}e0, {lng}e0)" for i, (c, lat, lng) in enumerate(CITY_ROWS)
) + ")"

_TYPE_SQL = """CASE event_type WHEN 'purchase' THEN 'message' WHEN 'view' THEN 'message'
  WHEN 'click' THEN 'reaction' WHEN 'signup' THEN 'subscription' ELSE 'registration' END"""

GEO_SQL = f"""{CITY_SQL},
ev AS (
  SELECT event_id, user_id, {_TYPE_SQL} AS event_type, ts, CAST(ts AS DATE) AS date,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE c.lat + 0.001e0 * (event_id % 50) END AS lat,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE c.lng + 0.001e0 * (event_id % 37) END AS lon
  FROM events JOIN city c
    ON c.idx = (user_id * 7 + CAST(floor(day(ts) / 10.0) AS BIGINT)) % 8
),
near AS (
  SELECT event_id, user_id, event_type, ts, date, city, km FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY km, city) AS rn FROM (
      SELECT e.event_id, e.user_id, e.event_type, e.ts, e.date, c.city,
        2 * 6371.0e0 * asin(sqrt(least(1.0e0,
          pow(sin((radians(c.lat) - radians(e.lat)) / 2), 2)
          + cos(radians(e.lat)) * cos(radians(c.lat))
            * pow(sin((radians(c.lng) - radians(e.lon)) / 2), 2)))) AS km
      FROM ev e CROSS JOIN city c WHERE e.lat IS NOT NULL AND e.lon IS NOT NULL))
  WHERE rn = 1
)"""

STREAK_SQL = GEO_SQL + """,
runs AS (
  SELECT user_id, city, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM (
    SELECT user_id, city, day,
      day - CAST(row_number() OVER (PARTITION BY user_id, city ORDER BY day) AS INTEGER) AS island
    FROM (SELECT DISTINCT user_id, city, date AS day FROM near WHERE event_type = 'message'))
  GROUP BY user_id, city, island
)"""


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CITY_ROWS), "city string, lat double, lng double")


def _event_type() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind.isin("purchase", "view"), "message")
        .when(kind == "click", "reaction")
        .when(kind == "signup", "subscription")
        .otherwise("registration")
    )


def _nested(events: DataFrame, lat: Column, lon: Column) -> DataFrame:
    kind = _event_type()
    user = F.col("user_id")
    is_message = kind == "message"
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.select(
        F.struct(
            F.when(is_message, user).alias("message_from"),
            F.when(F.col("event_type") == "purchase", (user * 13 + F.col("event_id")) % 150).alias(
                "message_to"
            ),
            F.col("event_id").alias("message_id"),
            text.alias("datetime"),
            F.when(kind == "subscription", F.col("event_id") % 20).alias("subscription_channel"),
            F.when(~is_message, user).alias("user"),
        ).alias("event"),
        kind.alias("event_type"),
        F.to_date("ts").alias("date"),
        F.when(F.col("event_id") % 97 != 0, lat).alias("lat"),
        F.when(F.col("event_id") % 89 != 0, lon).alias("lon"),
    )


def geo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lake whose users move between cities every ten days."""
    index = ((F.col("user_id") * 7 + F.floor(F.dayofmonth("ts") / 10)) % 8).cast("int")

    def of_city(part: int) -> Column:
        return F.element_at(F.array(*[F.lit(c[part]) for c in CITY_ROWS]), index + 1)

    return _nested(
        load(spark, sf_dir, "events"),
        of_city(1) + F.lit(0.001) * (F.col("event_id") % 50),
        of_city(2) + F.lit(0.001) * (F.col("event_id") % 37),
    )


def friend_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lake whose users stay on a street grid of one city."""
    return _nested(
        load(spark, sf_dir, "events"),
        F.lit(-33.8) - F.lit(0.005) * ((F.col("user_id") * 7) % 10),
        F.lit(151.2) + F.lit(0.005) * ((F.col("user_id") * 11) % 13),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem")
    rate = F.lit(3) + F.round(F.col("l_discount") * 20, 1)
    return items.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_suppkey").alias("courier_id"),
        rate.cast("decimal(3,1)").alias("rate"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("sum"),
        F.round(F.col("l_tax") * 100, 2).cast("decimal(14,2)").alias("tip_sum"),
        moment_id(F.col("l_shipdate")).alias("timestamp_id"),
    )


def couriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_suppkey").cast("string").alias("courier_id"),
        F.col("s_name").alias("courier_name"),
    )


LOG_SQL = """log AS (
  SELECT CAST(event_id % 20 AS INTEGER) AS group_id,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id,
    CASE WHEN event_id % 3 = 0 THEN CAST(user_id + 1 AS INTEGER) END AS user_id_from,
    CASE event_type WHEN 'signup' THEN 'add' ELSE 'leave' END AS event,
    ts AS event_dt
  FROM events WHERE event_type IN ('signup', 'error')
),
users AS (
  SELECT user_id AS id, min(ts) AS registration_dt FROM events
  WHERE user_id % 17 <> 0 GROUP BY user_id
),
grp AS (SELECT event_id % 20 AS id, min(ts) AS registration_dt FROM events GROUP BY event_id % 20),
dialogs AS (
  SELECT user_id AS message_from,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 20 END AS message_group
  FROM events WHERE event_type = 'purchase'
),
h_users AS (
  SELECT md5(CAST(id AS VARCHAR)) AS hk_user_id, id AS user_id, registration_dt FROM users
  WHERE id IN (SELECT user_id FROM log)
),
h_groups AS (
  SELECT md5(CAST(id AS VARCHAR)) AS hk_group_id, id AS group_id, registration_dt FROM grp
  WHERE id IN (SELECT group_id FROM log)
),
link AS (
  SELECT DISTINCT md5(CAST(l.user_id AS VARCHAR) || '|' || CAST(l.group_id AS VARCHAR))
      AS hk_l_user_group_activity, u.hk_user_id, g.hk_group_id
  FROM log l JOIN h_users u ON l.user_id = u.user_id JOIN h_groups g ON l.group_id = g.group_id
)"""


def group_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    eid, uid = F.col("event_id"), F.col("user_id")
    return events.select(
        (eid % 20).cast("int").alias("group_id"),
        F.when(eid % 53 != 0, uid.cast("int")).alias("user_id"),
        F.when(eid % 3 == 0, (uid + 1).cast("int")).alias("user_id_from"),
        F.when(F.col("event_type") == "signup", "add").otherwise("leave").alias("event"),
        F.col("ts").alias("event_dt"),
    )


def registered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").where(F.col("user_id") % 17 != 0)
    return events.groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("registration_dt"))


def registered_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.groupBy((F.col("event_id") % 20).alias("id")).agg(
        F.min("ts").alias("registration_dt")
    )


def dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return events.select(
        F.col("user_id").alias("message_from"),
        F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 20).alias("message_group"),
    )


AB_METRICS = ("revenue", "big", "urgent", "only_a")

AB_SQL = """daily AS (
  SELECT o_custkey AS user_id, CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS cohort,
    CAST(o_orderdate AS DATE) AS day, o_totalprice AS revenue,
    CASE WHEN o_totalprice > 300000 THEN 1.0e0 ELSE 0.0e0 END AS big,
    CASE WHEN o_orderpriority LIKE '1%' THEN 1.0e0 ELSE 0.0e0 END AS urgent,
    CASE WHEN o_custkey % 2 = 0 THEN 1.0e0 ELSE 0.0e0 END AS only_a
  FROM orders
),
per_user AS (
  SELECT user_id, cohort, count(day) AS day, sum(revenue) AS revenue, sum(big) AS big,
    sum(urgent) AS urgent, sum(only_a) AS only_a
  FROM daily GROUP BY user_id, cohort
),
long AS (
  SELECT user_id, cohort, 'day' AS metric, CAST(day AS DOUBLE) AS value FROM per_user
  UNION ALL SELECT user_id, cohort, 'revenue', revenue FROM per_user
  UNION ALL SELECT user_id, cohort, 'big', big FROM per_user
  UNION ALL SELECT user_id, cohort, 'urgent', urgent FROM per_user
  UNION ALL SELECT user_id, cohort, 'only_a', only_a FROM per_user
),
m AS (
  SELECT metric,
    count(*) FILTER (WHERE cohort = 'A') AS n_a, count(*) FILTER (WHERE cohort = 'B') AS n_b,
    avg(value) FILTER (WHERE cohort = 'A') AS mean_a, avg(value) FILTER (WHERE cohort = 'B') AS mean_b,
    var_samp(value) FILTER (WHERE cohort = 'A') AS var_a, var_samp(value) FILTER (WHERE cohort = 'B') AS var_b,
    sum(value) FILTER (WHERE cohort = 'A') AS a, sum(value) FILTER (WHERE cohort = 'B') AS b
  FROM long GROUP BY metric
)"""


def ab_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda condition: F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))
    in_a = F.col("o_custkey") % 2 == 0
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.when(in_a, "A").otherwise("B").alias("cohort"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("revenue"),
        one(F.col("o_totalprice") > 300000).alias("big"),
        one(F.col("o_orderpriority").startswith("1")).alias("urgent"),
        one(in_a).alias("only_a"),
    )


TELECOM_SQL = """contract AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerID, c_custkey AS k,
    DATE '2014-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS begin_day,
    CASE WHEN c_custkey % 4 <> 0 THEN NULL
      ELSE DATE '2014-01-01' + CAST(c_custkey % 2000 + c_custkey % 900 AS INTEGER) END AS end_day,
    CASE c_custkey % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS Type,
    CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    c_mktsegment AS PaymentMethod, 20.0e0 + c_custkey % 100 AS MonthlyCharges,
    CASE WHEN c_custkey % 50 = 0 THEN 0.0e0 ELSE c_acctbal END AS TotalCharges
  FROM customer
),
personal AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerID,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c_custkey % 5 = 1 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c_custkey % 7 = 1 THEN 'Yes' ELSE 'No' END AS Dependents
  FROM customer WHERE c_custkey % 11 <> 0
),
internet AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerID,
    CASE WHEN c_custkey % 4 < 2 THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
    CASE WHEN c_custkey % 8 < 3 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN c_custkey % 6 < 2 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN c_custkey % 10 < 5 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN c_custkey % 12 < 5 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN c_custkey % 14 < 6 THEN 'Yes' ELSE 'No' END AS StreamingMovies
  FROM customer WHERE c_custkey % 5 <> 0
),
phone AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerID,
    CASE WHEN c_custkey % 9 < 4 THEN 'Yes' ELSE 'No' END AS MultipleLines
  FROM customer WHERE c_custkey % 3 <> 0
),
view_ AS (
  SELECT coalesce(p.customerID, c.customerID, i.customerID, f.customerID) AS customerID,
    coalesce(gender, 'No') AS gender, SeniorCitizen, coalesce(Partner, 'No') AS Partner,
    coalesce(Dependents, 'No') AS Dependents, coalesce(Type, 'No') AS Type,
    coalesce(PaperlessBilling, 'No') AS PaperlessBilling,
    coalesce(PaymentMethod, 'No') AS PaymentMethod, MonthlyCharges, TotalCharges,
    dayname(begin_day) AS Day, CAST(month(begin_day) AS INTEGER) AS Month,
    CAST(year(begin_day) AS INTEGER) AS Year,
    CAST(coalesce(end_day, DATE '2020-02-01') - begin_day AS INTEGER) AS DaysInside,
    CASE WHEN end_day IS NULL THEN 1 ELSE 0 END AS is_active,
    coalesce(InternetService, 'No') AS InternetService, coalesce(TechSupport, 'No') AS TechSupport,
    coalesce(OnlineSecurity, 'No') AS OnlineSecurity, coalesce(OnlineBackup, 'No') AS OnlineBackup, coalesce(DeviceProtection, 'No') AS DeviceProtection, coalesce(StreamingTV, 'No') AS StreamingTV, coalesce(StreamingMovies, 'No') AS StreamingMovies,
    coalesce(MultipleLines, 'No') AS MultipleLines
  FROM personal p FULL JOIN contract c ON p.customerID = c.customerID
    FULL JOIN internet i ON coalesce(p.customerID, c.customerID) = i.customerID
    FULL JOIN phone f ON coalesce(p.customerID, c.customerID, i.customerID) = f.customerID
)"""


def telecom(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Contract, personal, internet and phone tables."""
    base = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    key = k.cast("string").alias("customerID")
    yes_no = lambda condition: F.when(condition, "Yes").otherwise("No")
    begin = F.date_add(F.lit("2014-01-01").cast("date"), (k % 2000).cast("int"))
    end = F.date_add(begin, (k % 900).cast("int"))
    contract = base.select(
        key,
        begin.cast("string").alias("BeginDate"),
        F.when(k % 4 != 0, "No").otherwise(F.concat(end.cast("string"), F.lit(" 00:00:00"))).alias(
            "EndDate"
        ),
        F.when(k % 3 == 0, "Month-to-month").when(k % 3 == 1, "One year").otherwise("Two year").alias(
            "Type"
        ),
        yes_no(k % 2 == 0).alias("PaperlessBilling"),
        F.col("c_mktsegment").alias("PaymentMethod"),
        (F.lit(20.0) + k % 100).alias("MonthlyCharges"),
        F.when(k % 50 == 0, " ").otherwise(F.col("c_acctbal").cast("string")).alias("TotalCharges"),
    )
    personal = base.where(k % 11 != 0).select(
        key,
        F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(k % 6 == 0, 1).otherwise(0).alias("SeniorCitizen"),
        yes_no(k % 5 == 1).alias("Partner"),
        yes_no(k % 7 == 1).alias("Dependents"),
    )
    internet = base.where(k % 5 != 0).select(
        key,
        F.when(k % 4 < 2, "DSL").otherwise("Fiber optic").alias("InternetService"),
        yes_no(k % 8 < 3).alias("TechSupport"),
        yes_no(k % 7 < 3).alias("OnlineSecurity"),
        yes_no(k % 6 < 2).alias("OnlineBackup"),
        yes_no(k % 10 < 5).alias("DeviceProtection"),
        yes_no(k % 12 < 5).alias("StreamingTV"),
        yes_no(k % 14 < 6).alias("StreamingMovies"),
    )
    phone = base.where(k % 3 != 0).select(key, yes_no(k % 9 < 4).alias("MultipleLines"))
    return contract, personal, internet, phone


def gappy_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with missing types and zero prices."""
    k = F.col("p_partkey")
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        "p_brand",
        F.when(k % 13 != 0, F.col("p_size")).alias("p_size"),
        F.when(k % 7 != 0, F.col("p_type")).alias("p_type"),
        F.when(k % 11 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("price"),
    )


PARTS_SQL = """parts AS (
  SELECT p_partkey, p_brand, CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS p_size,
    CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS p_type,
    CASE WHEN p_partkey % 11 = 0 THEN 0.0e0 ELSE p_retailprice END AS price
  FROM part
)"""


def adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Car adverts: brand, model and gaps from part, price from the retail price."""
    k = F.col("p_partkey")
    stamp = lambda days, seconds: F.date_format(
        F.lit("2016-03-05 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")),
        "yyyy-MM-dd HH:mm:ss",
    )
    return load(spark, sf_dir, "part").select(
        stamp(k % 30, k % 86_400).alias("DateCrawled"),
        F.when(k % 31 == 0, 0).otherwise(F.floor("p_retailprice")).cast("int").alias("Price"),
        F.when(k % 7 != 0, F.col("p_type")).alias("VehicleType"),
        (1970 + k % 50).cast("int").alias("RegistrationYear"),
        F.when(k % 9 != 0, F.when(k % 4 == 0, "auto").otherwise("manual")).alias("Gearbox"),
        F.when(k % 11 == 0, 0).otherwise(40 + (k * 37) % 1000).cast("int").alias("Power"),
        F.when(k % 5 != 0, F.concat(F.lit("m"), (F.col("p_size") % 4).cast("string"))).alias("Model"),
        (F.col("p_size") * 3000).cast("int").alias("Kilometer"),
        (k % 13).cast("int").alias("RegistrationMonth"),
        F.when(k % 10 != 0, F.when(k % 3 == 0, "gasoline").otherwise("petrol")).alias("FuelType"),
        F.col("p_brand").alias("Brand"),
        F.when(k % 6 != 0, F.when(k % 8 == 1, "yes").otherwise("no")).alias("NotRepaired"),
        F.when(k % 50 == 0, "unknown").otherwise(stamp(k % 20, F.lit(0))).alias("DateCreated"),
        F.lit(0).alias("NumberOfPictures"),
        (k % 9999).cast("int").alias("PostalCode"),
        stamp(k % 30 + 3, k % 3_600).alias("LastSeen"),
        k.alias("advert_id"),
    )
