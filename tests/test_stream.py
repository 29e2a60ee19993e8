import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from milepost.streaming import campaigns

NOW = dt.datetime(2024, 1, 1, 12)
INPUT = "key string, value string, timestamp timestamp"


def body(restaurant="r1", campaign="c1", start="2024-01-01T10:00:00", end="2024-01-01T14:00:00"):
    return json.dumps({
        "restaurant_id": restaurant, "adv_campaign_id": campaign, "adv_campaign_content": "x", "adv_campaign_owner": "o",
        "adv_campaign_owner_contact": "p", "adv_campaign_datetime_start": start, "adv_campaign_datetime_end": end,
        "datetime_created": "2024-01-01T09:00:00"})


def land(spark, folder, rows):
    spark.createDataFrame(rows, INPUT).coalesce(1).write.mode("append").parquet(folder)


class Job:
    """The stream over a folder, run to its end as often as asked."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, str(tmp_path / "in")
        self.feedback, self.pushed, self.state = (str(tmp_path / n) for n in ("feedback", "push", "state"))
        self.people = spark.createDataFrame([("u1", "r1"), ("u2", "r1"), ("u3", "r2")], "client_id string, restaraunt_id string")

    def run(self):
        stream = self.spark.readStream.schema(INPUT).parquet(self.folder)
        messages = campaigns.campaign_messages(stream, self.people, now=F.lit(NOW), salts=4)
        sinks = campaigns.two_sinks(campaigns.parquet_sink(self.feedback), campaigns.parquet_sink(self.pushed))
        query = campaigns.start(messages, sinks, self.state, available_now=True)
        query.awaitTermination()
        return query

    def sent(self):
        rows = self.spark.read.parquet(self.feedback).collect()
        return sorted((r["restaurant_id"], r["adv_campaign_id"], r["client_id"]) for r in rows)


def test_stream(spark, tmp_path):
    job = Job(spark, tmp_path)
    at = lambda minute, hour=10: dt.datetime(2024, 1, 1, hour, minute)
    land(spark, job.folder, [
        ("k", body(), at(0)), ("k", body(), at(5)), ("k", "{broken", at(6)), ("k", body(restaurant="r9"), at(7)),
        ("k", body(campaign="old", end="2024-01-01T11:00:00"), at(8)),
        ("k", body(campaign="soon", start="2024-01-01T13:00:00"), at(9)),
    ])
    job.run()
    assert job.sent() == [("r1", "c1", "u1"), ("r1", "c1", "u2")]
    row = spark.read.parquet(job.feedback).first()
    assert row["feedback"] is None and row["message_key"]
    values = [json.loads(r["value"]) for r in spark.read.parquet(job.pushed).collect()]
    assert {v["client_id"] for v in values} == {"u1", "u2"} and set(values[0]) == set(campaigns.OUTPUT)
    assert values[0]["adv_campaign_datetime_start"] == "2024-01-01T10:00:00.000Z"

    # A restart without new input adds nothing; a repeat within the watermark is dropped.
    job.run()
    land(spark, job.folder, [("k", body(), at(30)), ("k", body(restaurant="r2", campaign="c2"), at(0, 14))])
    job.run()
    assert job.sent() == [("r1", "c1", "u1"), ("r1", "c1", "u2"), ("r2", "c2", "u3")]

    # The state of the first campaign has expired: a late record is ignored, a new one counts again.
    land(spark, job.folder, [("k", body(), at(10))])
    land(spark, job.folder, [("k", body(), at(5, 14))])
    query = job.run()
    assert job.sent().count(("r1", "c1", "u1")) == 2
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(totals) <= 3


def test_repeated_batch_replaces_itself(spark, tmp_path):
    sink = campaigns.parquet_sink(str(tmp_path / "out"))
    batch = spark.range(3).withColumn("batch_id", F.lit(7))
    sink(batch, 7)
    sink(batch, 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_jdbc_sink_adds_only_missing_rows(spark, monkeypatch):
    table = []
    asked = []

    def read(session, options, query):
        asked.append(query)
        return session.createDataFrame([(k,) for k in table] or [("",)], "message_key string")

    monkeypatch.setattr(campaigns.jdbc, "read_table", read)
    monkeypatch.setattr(campaigns.jdbc, "append_table", lambda df, o, t: table.extend(r["message_key"] for r in df.collect()))
    sink = campaigns.jdbc_sink({}, "feedback")
    sink(spark.createDataFrame([("a",), ("b",)], "message_key string"), 3)
    sink(spark.createDataFrame([("a",), ("b",), ("c",)], "message_key string"), 3)
    assert sorted(table) == ["a", "b", "c"] and "batch_id = 3" in asked[0]


def test_hot_restaurant_is_spread(spark):
    people = spark.range(1000).selectExpr("string(id) as client_id", "'r1' as restaraunt_id")
    one = spark.createDataFrame([("k", body(), NOW)], INPUT)
    out = campaigns.match_subscribers(campaigns.parse_campaigns(one), people, F.lit(NOW), salts=8)
    assert out.count() == 1000


def test_subscribers_meet_campaigns_without_a_hint(spark):
    people = spark.range(100).selectExpr("string(id) as client_id", "'r1' as restaraunt_id")
    batch = campaigns.parse_campaigns(spark.createDataFrame([("k", body(), NOW)] * 2, INPUT))
    matched = campaigns.match_subscribers(batch, people, F.lit(NOW))
    assert matched.count() == 200
    assert "strategy=broadcast" not in matched._jdf.queryExecution().optimizedPlan().toString()


def test_salts_follow_the_number_of_subscribers(spark):
    people = spark.range(1000).selectExpr("string(id) as client_id", "if(id < 900, 'r1', concat('r', id)) as restaraunt_id")
    salts = campaigns.restaurant_salts(people, target_rows=100)
    assert [tuple(r) for r in salts.collect()] == [("r1", 9)]
    records = [("k", body(), NOW), ("k", body(restaurant="r950", campaign="c2"), NOW), ("k", body(restaurant="none"), NOW)]
    batch = campaigns.parse_campaigns(spark.createDataFrame(records, INPUT))
    out = campaigns.match_subscribers(batch, people, F.lit(NOW), salts)
    assert out.count() == 901 and out.distinct().count() == 901 and "salts" not in out.columns
    assert campaigns.restaurant_salts(people).count() == 0
    assert campaigns.match_subscribers(batch, people, F.lit(NOW)).count() == 901


@pytest.mark.parametrize("state", [campaigns.ROCKSDB, {}])
def test_state_survives_a_restart_and_is_evicted(spark, tmp_path, state):
    """Either state store drops repeats after a restart and forgets keys behind the watermark."""
    job = Job(spark, tmp_path)
    at = lambda minute, hour=10: dt.datetime(2024, 1, 1, hour, minute)

    def run():
        stream = spark.readStream.schema(INPUT).parquet(job.folder)
        messages = campaigns.campaign_messages(stream, job.people, now=F.lit(NOW))
        query = campaigns.start(messages, campaigns.parquet_sink(job.feedback + "/out"), job.state, available_now=True, state=state)
        query.awaitTermination()
        return [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    land(spark, job.folder, [("k", body(), at(0)), ("k", body(), at(5))])
    states = run()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert any("rocksdb" in k.lower() for k in states[-1]["customMetrics"]) == (state is campaigns.ROCKSDB)
    land(spark, job.folder, [("k", body(), at(20))])
    run()
    assert spark.read.parquet(job.feedback + "/out").count() == 2
    land(spark, job.folder, [("k", body(restaurant="r2", campaign="c2"), at(0, 14))])
    run()
    land(spark, job.folder, [("k", body(restaurant="r2", campaign="c2"), at(10, 14))])
    states = run()
    assert states[-1]["numRowsTotal"] == 1
    assert spark.read.parquet(job.feedback + "/out").count() == 3


def test_campaigns_are_kept_and_messages_are_not(spark, tmp_path):
    """Copies of a record go before the fan-out: state and cache hold campaigns, whatever number of clients they go to."""
    job = Job(spark, tmp_path)
    people = spark.range(500).selectExpr("string(id) as client_id", "'r1' as restaraunt_id")
    people = people.unionByName(people).unionByName(spark.sql("select string(null) as client_id, 'r1' as restaraunt_id"))
    at = lambda minute, hour=10: dt.datetime(2024, 1, 1, hour, minute)
    cached = []

    def push(batch, batch_id):
        relation = "InMemoryRelation"
        plan = batch._jdf.queryExecution().withCachedData().toString()
        cached.append(relation in plan and "client_id" not in plan.split(relation)[1].split("]")[0])
        campaigns.parquet_sink(job.pushed)(batch, batch_id)

    def run():
        stream = spark.readStream.schema(INPUT).parquet(job.folder)
        sinks = campaigns.send_to_subscribers(people, campaigns.parquet_sink(job.feedback), push, target_messages=100, now=F.lit(NOW))
        query = campaigns.start(campaigns.new_campaigns(stream), sinks, job.state, available_now=True)
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    open_ended = {"start": "2020-01-01T10:00:00", "end": "2999-01-01T14:00:00"}
    land(spark, job.folder, [("k", body(**open_ended), at(0)), ("k", body(**open_ended), at(5)), ("k", body(campaign="c2", **open_ended), at(6))])
    assert max(run()) == 2
    land(spark, job.folder, [("k", body(**open_ended), at(30))])
    assert max(run()) == 2
    rows = spark.read.parquet(job.feedback)
    assert rows.count() == 2 * 501 and rows.select("message_key").distinct().count() == 2 * 501
    assert rows.select("trigger_datetime_created").distinct().count() == 1
    values = spark.read.parquet(job.pushed)
    assert values.count() == 2 * 501 and all(cached) and cached


def test_pushed_texts_are_put_together_from_parts(spark, tmp_path):
    """The same texts as ``push_rows``, without JSON being made for each message; few state stores; nothing sent, nothing joined."""
    odd = 'a"b\\c/é中\n,}'
    people = spark.createDataFrame([(odd, "r1"), (None, "r1"), ("", "r1"), ("u", 'r"2'), ("u", "r9"), ("u", None)], "client_id string, restaraunt_id string")
    bare = json.dumps({"restaurant_id": 'r"2', "adv_campaign_datetime_start": "2024-01-01T10:00:00", "adv_campaign_datetime_end": "2024-01-01T14:00:00"})
    source, plans = str(tmp_path / "in"), []
    feedback, pushed, state = (str(tmp_path / n) for n in ("feedback", "push", "state"))

    def push(batch, batch_id):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        campaigns.parquet_sink(pushed)(batch, batch_id)

    def run():
        stream = spark.readStream.schema(INPUT).parquet(source)
        sinks = campaigns.send_to_subscribers(people, campaigns.parquet_sink(feedback), push, now=F.lit(NOW))
        before = spark.conf.get("spark.sql.shuffle.partitions")
        query = campaigns.start(campaigns.new_campaigns(stream, F.lit(NOW)), sinks, state, available_now=True, state_partitions=3)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        return {p["stateOperators"][0]["numStateStoreInstances"] for p in query.recentProgress if p["stateOperators"]}

    land(spark, source, [("k", body(campaign=odd), NOW), ("k", bare, NOW), ("k", body(restaurant="r0"), NOW)])
    assert run() == {3}
    sent = spark.read.parquet(feedback)
    want = sorted(r["value"] for r in campaigns.push_rows(sent).collect())
    assert len(want) == 4 and sorted(r["value"] for r in spark.read.parquet(pushed).collect()) == want
    assert "Join" in plans[0] and "json" not in plans[0].split("Join")[0].lower()
    plans.clear()
    land(spark, source, [("k", "{broken", NOW)])
    run()
    assert plans and not any("Join" in p for p in plans)
    assert spark.read.parquet(pushed).count() == 4 and spark.read.parquet(feedback).count() == 4
