"""Restaurant campaigns sent to the subscribers of the restaurant."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from milepost import schemas
from milepost.functions.scalars import hash_key
from milepost.operators.scratch import written
from milepost.sources import jdbc, kafka

WATERMARK = "60 minutes"
#: Subscribers of one restaurant that one task should get at most.
TARGET_ROWS = 200_000
#: Messages of one restaurant and batch that one task should write at most.
TARGET_MESSAGES = 1_000_000
#: State kept on local disk, with only its changes written to the checkpoint.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: The columns that tell a message from another, and those that are sent.
KEYS = (
    "restaurant_id", "adv_campaign_id", "adv_campaign_datetime_start",
    "adv_campaign_datetime_end", "client_id",
)
CAMPAIGN_KEYS = KEYS[:-1]
#: Columns of both sinks with another text in every row.
UNIQUE = ("message_key", "value")
OUTPUT = (
    "restaurant_id", "adv_campaign_id", "adv_campaign_content", "adv_campaign_owner",
    "adv_campaign_owner_contact", "adv_campaign_datetime_start", "adv_campaign_datetime_end",
    "client_id", "datetime_created", "trigger_datetime_created",
)


def parse_campaigns(records: DataFrame) -> DataFrame:
    """Records (key, value, timestamp) to campaign columns and ``timestamp``.

    Unreadable JSON parses to null fields and is told by its missing restaurant.
    """
    body = F.from_json(F.col("value").cast("string"), schemas.CAMPAIGN).alias("c")
    return records.select(body, "timestamp").select("c.*", "timestamp").where(
        F.col("restaurant_id").isNotNull()
    )


def active_campaigns(campaigns: DataFrame, now: Column | None = None) -> DataFrame:
    """Campaigns that have started and not ended; a fixed clock may be passed in."""
    clock = F.current_timestamp() if now is None else now
    return campaigns.where(
        (clock >= F.col("adv_campaign_datetime_start")) & (clock <= F.col("adv_campaign_datetime_end"))
    )


def restaurant_salts(subscribers: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(restaurant_id, salts) of the restaurants with more than ``target_rows`` subscribers, usually few.

    Counted once when a stream is built and written, so that micro-batches read a small table.
    """
    counts = subscribers.groupBy(F.col("restaraunt_id").alias("restaurant_id")).agg(F.count(F.lit(1)).alias("n"))
    large = counts.where((F.col("n") > target_rows) & F.col("restaurant_id").isNotNull())
    return written(large.select("restaurant_id", F.ceil(F.col("n") / target_rows).cast("int").alias("salts")), "restaurant-salts")


def match_subscribers(
    campaigns: DataFrame,
    subscribers: DataFrame,
    now: Column | None = None,
    salts: int | DataFrame | None = None,
    carry: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per campaign record and subscriber of its restaurant.

    A popular restaurant's subscribers are spread over sub-keys and only its campaign records repeated. ``salts`` is a
    result of ``restaurant_salts``, one number for all restaurants, or None to count them here. No side is hinted: Spark's
    own size check decides how they meet; with ``partitions``, both are dealt into so many first. ``carry`` are further
    columns of the subscribers.
    """
    clock = F.current_timestamp() if now is None else now
    people = subscribers.select(F.col("restaraunt_id").alias("restaurant_id"), "client_id", *carry)
    if isinstance(salts, int):
        cut = {"campaigns": campaigns, "people": people}
        number = F.lit(salts)
    else:
        sizes = restaurant_salts(subscribers) if salts is None else salts
        cut = {"campaigns": campaigns.join(sizes, "restaurant_id", "left"), "people": people.join(sizes, "restaurant_id", "left")}
        number = F.coalesce(F.col("salts"), F.lit(1))
    spread = F.explode(F.sequence(F.lit(0), number - 1))
    salt = F.pmod(F.xxhash64("client_id"), number).cast("int")
    sides = cut["campaigns"].withColumn("salt", spread).drop("salts"), cut["people"].withColumn("salt", salt).drop("salts")
    key = ["restaurant_id", "salt"]
    if partitions is not None:
        sides = tuple(side.repartition(partitions, *key) for side in sides)
    matched = sides[0].join(sides[1], key).drop("salt")
    return matched.withColumn("trigger_datetime_created", clock)


def campaign_messages(
    records: DataFrame,
    subscribers: DataFrame,
    now: Column | None = None,
    watermark: str = WATERMARK,
    salts: int | DataFrame | None = None,
) -> DataFrame:
    """Active campaigns per subscriber, once per key within the watermark.

    ``timestamp`` stays in the row up to the de-duplication, so its state is evicted as time moves. The state holds every
    message of the watermark, so that a client who subscribes between two copies of a record still gets it; where that does
    not matter, ``new_campaigns`` with ``send_to_subscribers`` keeps campaigns only.
    """
    active = active_campaigns(parse_campaigns(records), now).withWatermark("timestamp", watermark)
    matched = match_subscribers(active, subscribers, now, salts)
    return matched.dropDuplicatesWithinWatermark(list(KEYS)).select(*OUTPUT)


def new_campaigns(records: DataFrame, now: Column | None = None, watermark: str = WATERMARK) -> DataFrame:
    """Active campaigns, once per key within the watermark: for ``send_to_subscribers``.

    Copies of a record go before it meets its subscribers, so the state and its shuffle grow with campaigns, not messages.
    """
    active = active_campaigns(parse_campaigns(records), now).withWatermark("timestamp", watermark)
    return active.dropDuplicatesWithinWatermark(list(CAMPAIGN_KEYS))


def campaign_key() -> Column:
    """Hash of what tells a campaign from another."""
    return hash_key(*[F.col(k) for k in CAMPAIGN_KEYS])


def feedback_rows(batch: DataFrame, batch_id: int, campaign: Column | None = None) -> DataFrame:
    """Rows for the feedback table: a null ``feedback`` to be filled by the client, and the ids that
    let a repeated batch be recognised.

    The key of a message is its campaign's hash, ``campaign`` where it is known already, and its client: this packs well.
    """
    key = F.concat_ws("|", campaign_key() if campaign is None else campaign, "client_id")
    return batch.withColumns(
        {
            "feedback": F.lit(None).cast("string"),
            "batch_id": F.lit(batch_id).cast("long"),
            "message_key": key,
        }
    )


def push_rows(batch: DataFrame) -> DataFrame:
    """Rows with one JSON ``value`` for the outgoing topic."""
    return batch.select(F.to_json(F.struct(*OUTPUT)).alias("value"))


def json_fields(*columns: str) -> Column:
    """What ``to_json`` of these columns has between its braces; empty if all are null and nulls are left out."""
    whole = F.to_json(F.struct(*columns))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def after_comma(fields: Column) -> Column:
    """``json_fields`` as they follow others."""
    return F.when(fields == "", "").otherwise(F.concat(F.lit(","), fields))


def push_parts() -> dict[str, Column]:
    """``push_head`` and ``push_tail`` of a campaign: the text of ``push_rows`` before and after what ``push_client`` tells.

    A campaign that meets subscribers has a restaurant, so there is always a field before the client.
    """
    at = OUTPUT.index("client_id")
    head = F.concat(F.lit("{"), json_fields(*OUTPUT[:at]))
    return {"push_head": head, "push_tail": F.concat(after_comma(json_fields(*OUTPUT[at + 1:])), F.lit("}"))}


def push_client() -> Column:
    """The client's part of the text of ``push_rows``."""
    return after_comma(json_fields("client_id"))


Sink = Callable[[DataFrame, int], None]


def two_sinks(save_feedback: Sink, push: Sink) -> Sink:
    """A ``foreachBatch`` function that computes a batch once and hands it to both sinks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            save_feedback(feedback_rows(batch, batch_id), batch_id)
            push(push_rows(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def send_to_subscribers(
    subscribers: DataFrame,
    save_feedback: Sink,
    push: Sink,
    now: Column | None = None,
    target_messages: int = TARGET_MESSAGES,
) -> Sink:
    """A ``foreachBatch`` function over ``new_campaigns``: matches each batch with the subscribers and hands it to both sinks.

    Only the campaigns of a batch are kept, with the moment they were sent at; each sink matches them again, so that its
    messages are written as they arise and stay nowhere else. A restaurant is salted by the messages that the batch makes
    of it. A client who is listed twice gets a message once. The text of a pushed message is put together from its
    campaign's and its client's part, each made once; the messages are dealt into as many partitions as the session of the
    subscribers shuffles into, whatever number of them the state has.
    """
    people = subscribers.select("restaraunt_id", "client_id").distinct()
    partitions = int(subscribers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = people.groupBy(F.col("restaraunt_id").alias("restaurant_id")).agg(F.count(F.lit(1)).alias("listed"))
    listed = written(listed, "restaurant-sizes")
    sent_at, hashed = "trigger_datetime_created", "campaign_key"
    parts = ["push_head", "push_client", "push_tail"]

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.withColumns({sent_at: F.current_timestamp() if now is None else now, hashed: campaign_key()})
        kept = kept.withColumns(push_parts()).persist()
        try:
            sizes = kept.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("n")).join(listed, "restaurant_id")
            salts = F.ceil(F.col("n") * F.col("listed") / target_messages).cast("int").alias("salts")
            salts = written(sizes.select("restaurant_id", salts).where("salts > 1"), "batch-salts")
            told = people.withColumn("push_client", push_client())
            messages = match_subscribers(kept, told, F.col(sent_at), salts, ["push_client"], partitions)
            messages = messages.select(*OUTPUT, hashed, *parts)
            if kept.isEmpty():
                messages = messages.limit(0)
            save_feedback(feedback_rows(messages, batch_id, F.col(hashed)).drop(hashed, *parts), batch_id)
            push(messages.select(F.concat(*parts).alias("value")), batch_id)
        finally:
            kept.unpersist()

    return write


def parquet_sink(path: str) -> Sink:
    """Each batch in its own folder, replaced when the batch is repeated: effectively once.

    Messages of a campaign differ in their client only, which zstd sees across more of a page than snappy. Texts that no two
    rows share are neither looked up in a dictionary nor compared for statistics.
    """
    plain = {f"parquet.{what}#{c}": "false" for what in ("enable.dictionary", "column.statistics.enabled") for c in UNIQUE}

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("batch_id").write.mode("overwrite").option("compression", "zstd").options(**plain)
        rows.parquet(f"{path}/batch_id={batch_id}")

    return write


def jdbc_sink(options: Mapping[str, str], table: str) -> Sink:
    """Append the rows of a batch that the table does not hold yet.

    A repeated batch finds its own rows by ``batch_id`` and adds only what an earlier, broken attempt
    left out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"(SELECT message_key FROM {table} WHERE batch_id = {int(batch_id)}) own_rows"
        known = jdbc.read_table(batch.sparkSession, options, own)
        jdbc.append_table(batch.join(known, "message_key", "left_anti"), options, table)

    return write


def kafka_sink(options: Mapping[str, str], topic: str) -> Sink:
    """Send a batch to a topic, at least once; readers drop repeats by the five keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kafka.write_topic(batch, options, topic)

    return write


def start(
    messages: DataFrame,
    write: Sink,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
    state: Mapping[str, str] = ROCKSDB,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the query; its checkpoint belongs to the query, and the caller decides when it ends.

    ``state_partitions`` is the number of state stores, all of which commit in every micro-batch; a checkpoint keeps the
    number it began with.

    ``state`` is the state store of the query, held for as long as it starts and written into its checkpoint: RocksDB, so
    that the keys of the last hour neither fill the executors' heap nor are written out whole with every micro-batch.
    """
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    conf = messages.sparkSession.conf
    if state_partitions is not None:
        state = {**state, "spark.sql.shuffle.partitions": str(state_partitions)}
    before = {k: conf.get(k, None) for k in state}
    for k, v in state.items():
        conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
