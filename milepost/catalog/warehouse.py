"""Staging, dimensions, hubs, links, satellites, checks and conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from milepost import schemas
from milepost.catalog import derive
from milepost.catalog.registry import load, query, rounded
from milepost.operators.quality import check_table
from milepost.operators.profile import union_all
from milepost.operators.scratch import new_path
from milepost.plans import warehouse
from milepost.sources import files

_DT = "2024-02-01 00:00:00"
_LOAD_SQL = f"TIMESTAMP '{_DT}' AS load_dt, 's3' AS load_src"


def _load_dt():
    return F.lit(_DT).cast("timestamp_ntz")


def _hubs(spark, sf_dir):
    log = derive.group_log(spark, sf_dir)
    users = warehouse.load_hub(
        derive.registered_users(spark, sf_dir), log, "user_id", "hk_user_id", "user_id",
        load_dt=_load_dt(),
    )
    groups = warehouse.load_hub(
        derive.registered_groups(spark, sf_dir), log, "group_id", "hk_group_id", "group_id",
        load_dt=_load_dt(),
    )
    return log, users, groups


@query(
    "timestamp_dim",
    """SELECT epoch_us(ts) AS id, ts, CAST(year(ts) AS SMALLINT) AS year,
      CAST(month(ts) AS SMALLINT) AS month, CAST(day(ts) AS SMALLINT) AS day,
      strftime(ts, '%H:%M:%S') AS time, CAST(ts AS DATE) AS date
    FROM (SELECT DISTINCT o_orderdate AS ts FROM orders UNION SELECT DISTINCT ts FROM events)""",
)
def timestamp_dim(spark, sf_dir):
    moments = load(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("ts")).unionByName(
        load(spark, sf_dir, "events").select("ts")
    )
    return warehouse.timestamp_dimension(moments, "ts")


@query("hub_users", f"WITH {derive.LOG_SQL} SELECT *, {_LOAD_SQL} FROM h_users")
def hub_users(spark, sf_dir):
    return _hubs(spark, sf_dir)[1]


@query("hub_groups", f"WITH {derive.LOG_SQL} SELECT *, {_LOAD_SQL} FROM h_groups")
def hub_groups(spark, sf_dir):
    return _hubs(spark, sf_dir)[2]


@query(
    "hub_increment",
    f"""WITH {derive.LOG_SQL} SELECT *, {_LOAD_SQL} FROM h_users
    WHERE hk_user_id NOT IN (SELECT hk_user_id FROM h_users WHERE user_id % 2 = 0)""",
)
def hub_increment(spark, sf_dir):
    """Second load into a hub that already holds the even users."""
    log, users, _ = _hubs(spark, sf_dir)
    return warehouse.load_hub(
        derive.registered_users(spark, sf_dir), log, "user_id", "hk_user_id", "user_id",
        existing=users.where(F.col("user_id") % 2 == 0), load_dt=_load_dt(),
    )


@query(
    "hub_increment_bitmaps",
    f"""WITH {derive.LOG_SQL} SELECT *, {_LOAD_SQL} FROM h_users
    WHERE hk_user_id NOT IN (SELECT hk_user_id FROM h_users WHERE user_id % 2 = 0)""",
)
def hub_increment_bitmaps(spark, sf_dir):
    """The same second load with the ids of the log's two halves, and of the hub, held as merged bitmaps."""
    log, users, _ = _hubs(spark, sf_dir)
    first = F.col("event_dt") < F.lit("2024-01-10").cast("timestamp_ntz")
    days = [warehouse.id_bitmaps(log.where(part), "user_id") for part in (first, ~first | first.isNull())]
    known = warehouse.id_bitmaps(users.where(F.col("user_id") % 2 == 0), "user_id")
    return warehouse.load_hub_by_bitmaps(
        derive.registered_users(spark, sf_dir), warehouse.merge_bitmaps(days), known, "hk_user_id", "user_id", load_dt=_load_dt()
    )


@query("link_load", f"WITH {derive.LOG_SQL} SELECT *, {_LOAD_SQL} FROM link")
def link_load(spark, sf_dir):
    return warehouse.load_link(*_hubs(spark, sf_dir), load_dt=_load_dt())


@query(
    "link_increment",
    f"""WITH {derive.LOG_SQL} SELECT l.*, {_LOAD_SQL} FROM link l
    WHERE hk_group_id NOT IN (SELECT hk_group_id FROM h_groups WHERE group_id < 10)""",
)
def link_increment(spark, sf_dir):
    """Second load into a link that already holds the first ten groups."""
    log, users, groups = _hubs(spark, sf_dir)
    old = warehouse.load_link(log, users, groups.where(F.col("group_id") < 10), load_dt=_load_dt())
    return warehouse.load_link(log, users, groups, existing=old, load_dt=_load_dt())


@query(
    "link_rejects",
    f"""WITH {derive.LOG_SQL}
    SELECT DISTINCT l.user_id, l.group_id FROM log l
      LEFT JOIN h_users u ON l.user_id = u.user_id LEFT JOIN h_groups g ON l.group_id = g.group_id
    WHERE hk_user_id IS NULL OR hk_group_id IS NULL""",
)
def link_rejects(spark, sf_dir):
    return warehouse.link_rejects(*_hubs(spark, sf_dir))


_SATELLITE_SQL = """sat AS (
  SELECT DISTINCT md5(CAST(user_id AS VARCHAR) || '|' || CAST(group_id AS VARCHAR))
    AS hk_l_user_group_activity, user_id_from, event, event_dt
  FROM log WHERE user_id IS NOT NULL
)"""


@query(
    "satellite_load",
    f"""WITH {derive.LOG_SQL}, {_SATELLITE_SQL}
    SELECT *, {_LOAD_SQL} FROM sat
    WHERE hk_l_user_group_activity IN (SELECT hk_l_user_group_activity FROM link)""",
)
def satellite_load(spark, sf_dir):
    log, users, groups = _hubs(spark, sf_dir)
    link = warehouse.load_link(log, users, groups, load_dt=_load_dt())
    return warehouse.load_satellite(log, link, load_dt=_load_dt())


@query(
    "satellite_increment",
    f"""WITH {derive.LOG_SQL}, {_SATELLITE_SQL}
    SELECT *, {_LOAD_SQL} FROM sat
    WHERE event = 'leave'
      AND hk_l_user_group_activity IN (SELECT hk_l_user_group_activity FROM link)""",
)
def satellite_increment(spark, sf_dir):
    """Second load into a satellite that already holds the joins of groups."""
    log, users, groups = _hubs(spark, sf_dir)
    link = warehouse.load_link(log, users, groups, load_dt=_load_dt())
    old = warehouse.load_satellite(log.where(F.col("event") == "add"), link, load_dt=_load_dt())
    return warehouse.load_satellite(log, link, existing=old, load_dt=_load_dt())


@query(
    "satellite_rejects",
    f"""WITH {derive.LOG_SQL}
    SELECT group_id, user_id, user_id_from, event, event_dt FROM log
    WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM h_users)""",
)
def satellite_rejects(spark, sf_dir):
    log, users, groups = _hubs(spark, sf_dir)
    return warehouse.satellite_rejects(log, warehouse.load_link(log, users, groups))


_CONVERSION_SQL = f"""WITH {derive.LOG_SQL},
added AS (SELECT group_id, count(DISTINCT user_id) AS a FROM log WHERE event = 'add' GROUP BY group_id),
wrote AS (SELECT message_group, count(DISTINCT message_from) AS w FROM dialogs
  WHERE message_group IS NOT NULL GROUP BY message_group)
SELECT hk_group_id, a AS cnt_added_users, w AS cnt_users_in_group_with_messages,
  round(w / a, 2) AS group_conversion, registration_dt
FROM added JOIN wrote ON group_id = message_group JOIN h_groups g ON g.group_id = added.group_id
ORDER BY registration_dt, g.group_id"""


@query("group_conversion", _CONVERSION_SQL + " LIMIT 10")
def group_conversion(spark, sf_dir):
    log, _, groups = _hubs(spark, sf_dir)
    return warehouse.group_conversion(log, derive.dialogs(spark, sf_dir), groups)


@query("group_conversion_bitmaps", _CONVERSION_SQL)
def group_conversion_bitmaps(spark, sf_dir):
    """All groups from bitmaps of users that are merged day by day."""
    log, _, groups = _hubs(spark, sf_dir)
    dialogs = derive.dialogs(spark, sf_dir).withColumnRenamed("message_group", "group_id").where("group_id is not null")
    half = F.col("user_id") % 3 == 0
    added = log.where(F.col("event") == "add")
    parts = [warehouse.id_bitmaps(added.where(c), "user_id", ["group_id"]) for c in (half, ~half)]
    wrote = warehouse.id_bitmaps(dialogs, "message_from", ["group_id"])
    return warehouse.group_conversion_from(warehouse.merge_bitmaps(parts, ["group_id"]), wrote, groups)


@query("group_conversion_all", _CONVERSION_SQL)
def group_conversion_all(spark, sf_dir):
    log, _, groups = _hubs(spark, sf_dir)
    return warehouse.group_conversion(log, derive.dialogs(spark, sf_dir), groups, k=None)


@query(
    "oldest_groups",
    f"""WITH {derive.LOG_SQL}
    SELECT id, registration_dt FROM grp ORDER BY registration_dt, id LIMIT 10""",
)
def oldest_groups(spark, sf_dir):
    return warehouse.oldest_groups(derive.registered_groups(spark, sf_dir))


@query(
    "group_members",
    f"""WITH {derive.LOG_SQL}
    SELECT group_id, count(DISTINCT user_id) AS users, count(*) AS n FROM log GROUP BY group_id
    ORDER BY users DESC, group_id""",
)
def group_members(spark, sf_dir):
    """Count distinct per group, in descending order."""
    return (
        derive.group_log(spark, sf_dir)
        .groupBy("group_id")
        .agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("users"), "group_id")
    )


@query(
    "constraint_report",
    """SELECT 'orders' AS "table", 'o_orderkey not null' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'orders', 'year in range', count(*) FILTER (WHERE NOT (year(o_orderdate) >= 1996 AND year(o_orderdate) < 2500)) FROM orders
    UNION ALL SELECT 'orders', 'o_orderkey unique', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'orders', 'o_custkey references parent', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)
    UNION ALL SELECT 'lineitem', 'l_discount not null', count(*) FILTER (WHERE l_discount IS NULL) FROM lineitem
    UNION ALL SELECT 'lineitem', 'quantity below fifty', count(*) FILTER (WHERE NOT l_quantity < 50) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_orderkey, l_linenumber unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'part', 'price non-negative', count(*) FILTER (WHERE NOT p_retailprice >= 0) FROM part""",
)
def constraint_report(spark, sf_dir):
    orders, items = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    customers = load(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 0)
    year = F.year("o_orderdate")
    return union_all([
        check_table(
            orders, "orders", not_null=["o_orderkey"],
            rules={"year in range": (year >= 1996) & (year < 2500)},
            unique=[["o_orderkey"]], references=[("o_custkey", customers, "c_custkey")],
        ),
        check_table(
            items, "lineitem", not_null=["l_discount"],
            rules={"quantity below fifty": F.col("l_quantity") < 50},
            unique=[["l_orderkey", "l_linenumber"]],
        ),
        check_table(load(spark, sf_dir, "part"), "part",
                    rules={"price non-negative": F.col("p_retailprice") >= 0}),
    ])


@query(
    "json_staging",
    """SELECT CAST(event_id AS VARCHAR) AS object_id,
      CAST(json_extract_string(props, '$.k') AS VARCHAR) AS object_value FROM events""",
)
def json_staging(spark, sf_dir):
    """JSON text to staged (object_id, object_value) rows."""
    body = F.from_json("props", "k string")
    rows = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("object_id"), body["k"].alias("object_value")
    )
    return warehouse.load_staging(rows, None, ["object_id"])


@query(
    "object_pages",
    """SELECT CAST(s_suppkey AS VARCHAR) AS object_id, s_name AS object_value FROM supplier
    WHERE s_suppkey % 3 <> 0""",
)
def object_pages(spark, sf_dir):
    """Landed pages of JSON arrays, every page read; objects already staged are left out."""
    path = new_path(spark, "object-pages")
    rows = load(spark, sf_dir, "supplier").select(
        F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name"),
                           F.col("s_acctbal").alias("unused"))).alias("o"),
        F.floor(F.col("s_suppkey") / 50).alias("page"),
    )
    pages = rows.groupBy("page").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("o")), F.lit("]")).alias("value"))
    pages.select("page", "value").write.partitionBy("page").text(path)
    objects = files.read_named_objects(spark, path, multi_line=False)
    staged = objects.where(F.col("object_id").cast("long") % 3 == 0)
    return warehouse.load_staging(objects, staged, ["object_id"])


@query(
    "delivery_pages",
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS n,
      CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS total,
      CAST(sum(CAST(floor(l_tax * 100) AS BIGINT)) AS BIGINT) AS tips
    FROM lineitem GROUP BY l_orderkey""",
)
def delivery_pages(spark, sf_dir):
    """Landed delivery objects as nine-field staging rows."""
    path = new_path(spark, "delivery-pages")
    item = load(spark, sf_dir, "lineitem")
    text = lambda c: F.col(c).cast("string")
    item.select(
        text("l_orderkey").alias("order_id"),
        text("l_shipdate").alias("order_ts"),
        text("l_linenumber").alias("delivery_id"),
        text("l_suppkey").alias("courier_id"),
        F.lit("street").alias("address"),
        text("l_shipdate").alias("delivery_ts"),
        F.lit(4).alias("rate"),
        F.floor("l_extendedprice").cast("int").alias("sum"),
        F.floor(F.col("l_tax") * 100).cast("int").alias("tip_sum"),
        F.lit("unused").alias("other"),
    ).write.json(path)
    staged = files.read_delivery_pages(spark, path, multi_line=False)
    return staged.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sum").alias("total"), F.sum("tip_sum").alias("tips")
    )


@query(
    "group_log_file",
    f"""WITH {derive.LOG_SQL}
    SELECT group_id, user_id, user_id_from, event, event_dt FROM log""",
)
def group_log_file(spark, sf_dir):
    """CSV with nullable integers, read by schema and appended to a table in one write."""
    source, table = new_path(spark, "group-log-csv"), new_path(spark, "group-log")
    log = derive.group_log(spark, sf_dir)
    stamp = F.date_format("event_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    log.withColumn("event_dt", stamp).write.option("header", True).csv(source)
    files.append_rows(files.read_group_log(spark, source), table, log.columns)
    return spark.read.schema(schemas.GROUP_LOG).parquet(table)


@query(
    "repeated_load",
    f"""WITH {derive.LOG_SQL}
    SELECT CASE WHEN group_id % 2 = 0 THEN 'even' ELSE 'odd' END AS load_id, group_id, user_id, event, event_dt FROM log""",
)
def repeated_load(spark, sf_dir):
    """Two loads of the log into one table, each of them sent twice."""
    table, log = new_path(spark, "loads"), derive.group_log(spark, sf_dir)
    for name, rest in (("even", 0), ("odd", 1)) * 2:
        files.load_once(log.where(F.pmod("group_id", F.lit(2)) == rest), table, name, ["group_id", "user_id", "event", "event_dt"])
    return spark.read.parquet(table).select("load_id", "group_id", "user_id", "event", "event_dt")


@query(
    "corrupt_lines",
    """SELECT CAST(p_partkey AS INTEGER) AS id,
      CASE WHEN p_partkey % 100 = 0 THEN NULL ELSE CAST(p_size AS INTEGER) END AS size,
      p_partkey % 100 = 0 AS corrupt
    FROM part""",
)
def corrupt_lines(spark, sf_dir):
    """Lines that do not fit the schema keep their place and are told apart."""
    path = new_path(spark, "corrupt-csv")
    k = F.col("p_partkey")
    load(spark, sf_dir, "part").select(
        k.alias("id"),
        F.when(k % 100 == 0, "big").otherwise(F.col("p_size").cast("string")).alias("size"),
    ).write.option("header", True).csv(path)
    rows = files.read_csv(spark, path, "id int, size int", keep_corrupt=True)
    return rows.select("id", "size", F.col(files.CORRUPT).isNotNull().alias("corrupt"))


@query(
    "load_day_partition",
    f"""WITH {derive.LOG_SQL}
    SELECT group_id, count(*) AS n FROM log WHERE CAST(event_dt AS DATE) = DATE '2024-01-05'
    GROUP BY group_id""",
)
def load_day_partition(spark, sf_dir):
    """Table partitioned by load date; one day is read by partition pruning."""
    path = new_path(spark, "log-by-day")
    log = derive.group_log(spark, sf_dir).withColumn("load_date", F.to_date("event_dt"))
    files.write_parquet(log, path, partition_by=["load_date"])
    day = spark.read.parquet(path).where(F.col("load_date") == F.lit("2024-01-05").cast("date"))
    return day.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "json_build",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","at":"'
      || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' AS value FROM events""",
)
def json_build(spark, sf_dir):
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    return load(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct("event_id", "event_type", at)).alias("value")
    )


@query(
    "labelled_files",
    """SELECT 'lang=' || lang AS label, true AS several, sum(strlen(text) + 1) :: BIGINT AS bytes,
      sum(length(text) + 1) :: BIGINT AS chars, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS "index"
    FROM documents GROUP BY lang""",
)
def labelled_files(spark, sf_dir):
    """File tree with labels as directory names and whole texts as content: sizes per label and label numbers."""
    path = new_path(spark, "labelled")
    docs = load(spark, sf_dir, "documents").select("lang", F.col("text").alias("value"), "doc_id")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(16))
    docs.repartition(16, "lang", spread).select("lang", "value").write.partitionBy("lang").text(path)
    found = files.read_labelled_files(spark, path, "*.txt")
    sizes = found.groupBy("label").agg(
        F.sum("length").alias("bytes"), F.sum(F.length(F.decode("content", "UTF-8"))).cast("bigint").alias("chars")
    )
    several = files.label_counts(found).select("label", (F.col("n") > 1).alias("several"))
    return several.join(sizes, "label").join(files.class_indices(found), "label")
