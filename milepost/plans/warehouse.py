"""Staging, dimension, hub, link and satellite loads.

Every load returns the rows to append; a second load of the same input returns none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.scalars import hash_key, moment_id
from milepost.operators.profile import union_all
from milepost.operators.skew import lookup_join


def _load_columns(load_dt: Column | None, load_src: str) -> dict[str, Column]:
    return {
        "load_dt": F.current_timestamp().cast("timestamp_ntz") if load_dt is None else load_dt,
        "load_src": F.lit(load_src),
    }


def load_staging(rows: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows with a natural key that is not staged yet, one per key (the lowest on the other
    columns, so that a repeated load picks the same one)."""
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys]
    fresh = rows.dropna(subset=keys)
    if existing is not None:
        fresh = fresh.join(existing.select(*keys).distinct(), keys, "left_anti")
    if not others:
        return fresh.distinct()
    one = fresh.groupBy(*keys).agg(F.min(F.struct(*others)).alias("row"))
    return one.select(*keys, "row.*").select(*rows.columns)


def timestamp_dimension(moments: DataFrame, ts: str) -> DataFrame:
    """Distinct moments with their parts; the id is the moment itself in microseconds."""
    at = F.col(ts).cast("timestamp_ntz")
    distinct = moments.select(at.alias("ts")).where(F.col("ts").isNotNull()).distinct()
    return distinct.select(
        moment_id(F.col("ts")).alias("id"),
        "ts",
        F.year("ts").cast("smallint").alias("year"),
        F.month("ts").cast("smallint").alias("month"),
        F.dayofmonth("ts").cast("smallint").alias("day"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.to_date("ts").alias("date"),
    )


def load_hub(
    registered: DataFrame,
    log: DataFrame,
    log_key: str,
    hub_key: str,
    natural_key: str,
    existing: DataFrame | None = None,
    load_dt: Column | None = None,
    load_src: str = "s3",
) -> DataFrame:
    """Registered ids that occur in the log and are not in the hub yet.

    The log is reduced to distinct ids before it is shuffled.
    """
    seen = log.select(F.col(log_key).alias("id")).where(F.col("id").isNotNull()).distinct()
    used = registered.select("id", "registration_dt").join(seen, "id", "left_semi").distinct()
    rows = used.select(
        hash_key(F.col("id")).alias(hub_key), F.col("id").alias(natural_key), "registration_dt"
    )
    if existing is not None:
        rows = rows.join(existing.select(hub_key).distinct(), hub_key, "left_anti")
    return rows.withColumns(_load_columns(load_dt, load_src))


def load_link(
    log: DataFrame,
    hub_users: DataFrame,
    hub_groups: DataFrame,
    existing: DataFrame | None = None,
    load_dt: Column | None = None,
    load_src: str = "s3",
) -> DataFrame:
    """Distinct (user, group) pairs of the log whose both hub keys exist."""
    pairs = _distinct_pairs(log)
    keyed = _keyed_pairs(pairs, hub_users, hub_groups)
    rows = keyed.where(F.col("hk_user_id").isNotNull() & F.col("hk_group_id").isNotNull()).select(
        hash_key(F.col("user_id"), F.col("group_id")).alias("hk_l_user_group_activity"),
        "hk_user_id",
        "hk_group_id",
    )
    if existing is not None:
        known = existing.select("hk_l_user_group_activity").distinct()
        rows = rows.join(known, "hk_l_user_group_activity", "left_anti")
    return rows.withColumns(_load_columns(load_dt, load_src))


def link_rejects(log: DataFrame, hub_users: DataFrame, hub_groups: DataFrame) -> DataFrame:
    """Distinct (user, group) pairs of the log without a user or group in the hubs."""
    keyed = _keyed_pairs(_distinct_pairs(log), hub_users, hub_groups)
    missing = F.col("hk_user_id").isNull() | F.col("hk_group_id").isNull()
    return keyed.where(missing).select("user_id", "group_id")


def _distinct_pairs(log: DataFrame) -> DataFrame:
    return log.select("user_id", "group_id").distinct()


def _keyed_pairs(pairs: DataFrame, hub_users: DataFrame, hub_groups: DataFrame) -> DataFrame:
    """Pairs with both hub keys, null where a hub lacks the id.

    A group may own most of the pairs, so that lookup is salted.
    """
    users = hub_users.select("user_id", "hk_user_id")
    groups = hub_groups.select("group_id", "hk_group_id")
    with_group = lookup_join(pairs, groups, ["group_id"], "left")
    return lookup_join(with_group, users, ["user_id"], "left")


def load_satellite(
    log: DataFrame,
    link: DataFrame,
    existing: DataFrame | None = None,
    load_dt: Column | None = None,
    load_src: str = "s3",
) -> DataFrame:
    """Log attributes under the key of their own (user, group) link; each distinct row once.

    Link keys are hashes of the natural ids, so one semi-join replaces the chain of hub lookups. The
    rows are made distinct first, on their whole content, which no single pair can crowd.
    """
    attributes = ["user_id_from", "event", "event_dt"]
    rows = (
        log.where(F.col("user_id").isNotNull() & F.col("group_id").isNotNull())
        .select(
            hash_key(F.col("user_id"), F.col("group_id")).alias("hk_l_user_group_activity"),
            *attributes,
        )
        .distinct()
    )
    known = link.select("hk_l_user_group_activity").distinct()
    rows = lookup_join(rows, known, ["hk_l_user_group_activity"], "left_semi")
    if existing is not None:
        content = ["hk_l_user_group_activity", *attributes]
        renamed = existing.select(*content).distinct().withColumnsRenamed(
            {c: f"__e_{c}" for c in content}
        )
        same = F.lit(True)
        for c in content:
            same = same & rows[c].eqNullSafe(renamed[f"__e_{c}"])
        rows = rows.join(renamed, same, "left_anti")
    return rows.withColumns(_load_columns(load_dt, load_src))


def satellite_rejects(log: DataFrame, link: DataFrame) -> DataFrame:
    """Log rows whose (user, group) has no link, or no complete key."""
    keyed = log.withColumn(
        "hk_l_user_group_activity",
        F.when(
            F.col("user_id").isNotNull() & F.col("group_id").isNotNull(),
            hash_key(F.col("user_id"), F.col("group_id")),
        ),
    )
    known = link.select("hk_l_user_group_activity").distinct()
    return lookup_join(keyed, known, ["hk_l_user_group_activity"], "left_anti").drop(
        "hk_l_user_group_activity"
    )


def group_conversion(
    log: DataFrame, dialogs: DataFrame, hub_groups: DataFrame, k: int | None = 10
) -> DataFrame:
    """Users who joined, users who wrote and their ratio for the ``k`` oldest groups (all if None).

    Both sides are counted per group before they meet the hub.
    """
    added = (
        log.where(F.col("event") == "add")
        .groupBy("group_id")
        .agg(F.count_distinct("user_id").alias("cnt_added_users"))
    )
    wrote = (
        dialogs.where(F.col("message_group").isNotNull())
        .groupBy(F.col("message_group").alias("group_id"))
        .agg(F.count_distinct("message_from").alias("cnt_users_in_group_with_messages"))
    )
    rows = _conversion(added, wrote, hub_groups)
    if k is not None:
        rows = rows.orderBy("registration_dt", "group_id").limit(k)
    return rows.drop("group_id")


def _conversion(added: DataFrame, wrote: DataFrame, hub_groups: DataFrame) -> DataFrame:
    share = F.try_divide("cnt_users_in_group_with_messages", "cnt_added_users")
    return (
        added.join(wrote, "group_id")
        .join(hub_groups.select("group_id", "hk_group_id", "registration_dt"), "group_id")
        .select(
            "hk_group_id",
            "cnt_added_users",
            "cnt_users_in_group_with_messages",
            F.round(share, 2).alias("group_conversion"),
            "registration_dt",
            "group_id",
        )
    )


def id_bitmaps(rows: DataFrame, ids: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bucket, bits): the distinct non-null whole-number ids of each key, exactly, 32,768 of them in a row."""
    at = F.col(ids).cast("bigint")
    known = rows.where(at.isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def merge_bitmaps(parts: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The union of the ids of several ``id_bitmaps`` tables, for example of a new day and all days before."""
    return union_all(list(parts)).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of distinct ids of each key."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def in_bitmaps(rows: DataFrame, bitmaps: DataFrame, ids: str, found: bool = True) -> DataFrame:
    """The rows whose id is (or, with ``found=False``, is not) among the ids of a table without keys; null ids are not."""
    at = F.col(ids).cast("bigint")
    place = F.bitmap_bit_position(at)
    byte = F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    bit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.lit(1) * F.pow(F.lit(2), place % 8).cast("int")) != 0
    met = lookup_join(rows.withColumn("bucket", F.bitmap_bucket_number(at)), bitmaps.select("bucket", "bits"), ["bucket"], "left")
    held = F.coalesce(bit, F.lit(False))
    return met.where(held if found else ~held).drop("bucket", "bits")


def load_hub_by_bitmaps(
    registered: DataFrame,
    seen: DataFrame,
    known: DataFrame,
    hub_key: str,
    natural_key: str,
    load_dt: Column | None = None,
    load_src: str = "s3",
) -> DataFrame:
    """``load_hub`` where the ids of the log (``seen``) and of the hub (``known``) are bitmap tables.

    Registered rows meet one row per 32,768 ids, whatever the number of log lines and of loads before. Merging today's
    ids into ``seen`` and the loaded ones into ``known`` keeps both for the next load.
    """
    used = in_bitmaps(registered.select("id", "registration_dt").distinct(), seen, "id")
    fresh = in_bitmaps(used, known, "id", found=False)
    rows = fresh.select(hash_key(F.col("id")).alias(hub_key), F.col("id").alias(natural_key), "registration_dt")
    return rows.withColumns(_load_columns(load_dt, load_src))


def group_conversion_from(added: DataFrame, wrote: DataFrame, hub_groups: DataFrame) -> DataFrame:
    """``group_conversion`` of all groups from bitmap tables by ``group_id`` of the users who joined and who wrote."""
    a = bitmap_counts(added, ["group_id"], "cnt_added_users")
    w = bitmap_counts(wrote, ["group_id"], "cnt_users_in_group_with_messages")
    return _conversion(a, w, hub_groups).drop("group_id")


def oldest_groups(groups: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` groups registered first: a top-k, not a full sort."""
    return groups.orderBy("registration_dt", "id").limit(k)
