import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from milepost import schemas
from milepost.operators.scratch import new_path, shared_folder, written
from milepost.plans import warehouse
from milepost.sources import files, jdbc, kafka

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def vault(spark):
    log = spark.createDataFrame(
        [(1, 10, None, "add", T0), (2, 10, 11, "add", T0), (1, 11, None, "add", T0), (1, 11, None, "add", T0),
         (1, None, None, "add", T0), (3, 99, None, "leave", T0)],
        schemas.GROUP_LOG)
    users = spark.createDataFrame([(10, T0), (11, T0), (12, T0)], schemas.REGISTERED)
    groups = spark.createDataFrame([(1, T0), (2, T0), (4, T0)], schemas.REGISTERED)
    hub_u = warehouse.load_hub(users, log, "user_id", "hk_user_id", "user_id")
    hub_g = warehouse.load_hub(groups, log, "group_id", "hk_group_id", "group_id")
    return log, users, groups, hub_u, hub_g


def test_hub_holds_used_ids_and_loads_once(vault):
    log, users, _, hub_u, _ = vault
    assert sorted(r["user_id"] for r in hub_u.collect()) == [10, 11]
    assert warehouse.load_hub(users, log, "user_id", "hk_user_id", "user_id", existing=hub_u).count() == 0
    half = hub_u.where("user_id = 10")
    again = warehouse.load_hub(users, log, "user_id", "hk_user_id", "user_id", existing=half)
    assert [r["user_id"] for r in again.collect()] == [11]


def test_link_and_satellite_load_once_and_reject_the_rest(vault):
    log, _, _, hub_u, hub_g = vault
    link = warehouse.load_link(log, hub_u, hub_g)
    assert link.count() == 3
    assert warehouse.load_link(log, hub_u, hub_g, existing=link).count() == 0
    assert sorted((r["user_id"] or 0, r["group_id"]) for r in warehouse.link_rejects(log, hub_u, hub_g).collect()) == [(0, 1), (99, 3)]
    sat = warehouse.load_satellite(log, link)
    # One row per (user, group): the other users of a group do not multiply it, equal rows are one.
    assert sat.count() == 3
    assert warehouse.load_satellite(log, link, existing=sat).count() == 0
    assert warehouse.satellite_rejects(log, link).count() == 2


def test_conversion(spark, vault):
    log, _, _, _, hub_g = vault
    dialogs = spark.createDataFrame([(10, 1), (10, 1), (12, 2), (13, 2), (5, None)], schemas.DIALOGS)
    got = {r["hk_group_id"]: r for r in warehouse.group_conversion(log, dialogs, hub_g).collect()}
    by_id = {r["group_id"]: got[r["hk_group_id"]] for r in hub_g.collect()}
    assert (by_id[1]["cnt_added_users"], by_id[1]["cnt_users_in_group_with_messages"], by_id[1]["group_conversion"]) == (2, 1, 0.5)
    assert by_id[2]["group_conversion"] == 2.0
    assert warehouse.group_conversion(log, dialogs, hub_g, k=1).count() == 1


def test_staging_is_idempotent(spark):
    rows = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3"), (None, "x")], schemas.RAW_OBJECT)
    first = warehouse.load_staging(rows, None, ["object_id"])
    assert sorted(map(tuple, first.collect())) == [("a", "1"), ("b", "3")]
    assert warehouse.load_staging(rows, first, ["object_id"]).count() == 0


def test_timestamp_dimension(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59, 58),)] * 2 + [(None,)], "ts timestamp_ntz")
    got = warehouse.timestamp_dimension(rows, "ts").collect()
    assert len(got) == 1
    assert tuple(got[0])[2:] == (2024, 2, 29, "23:59:58", dt.date(2024, 2, 29))


def test_csv_cities_and_json_pages(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id;city;lat;lng\n1;A;-33,5;151,25\n2;B;x;1\n")
    assert [tuple(r) for r in files.read_cities(spark, str(tmp_path / "c.csv")).collect()] == [("A", -33.5, 151.25), ("B", None, 1.0)]
    pages = tmp_path / "pages"
    pages.mkdir()
    for n, page in enumerate([[{"_id": "1", "name": "x"}, {"_id": "2", "name": "y"}], [{"_id": "3", "name": "z"}]]):
        (pages / f"{n}.json").write_text(json.dumps(page, indent=1))
    assert sorted(r["object_id"] for r in files.read_named_objects(spark, str(pages)).collect()) == ["1", "2", "3"]
    one = {"order_id": "o", "order_ts": "t", "delivery_id": "d", "courier_id": "c", "address": "a", "delivery_ts": "t", "rate": 5, "sum": 10, "tip_sum": 1, "extra": 1}
    (tmp_path / "d.json").write_text(json.dumps([one, one]))
    got = files.read_delivery_pages(spark, str(tmp_path / "d.json"))
    assert got.count() == 2 and len(got.columns) == 9


def test_group_log_keeps_nulls(spark, tmp_path):
    (tmp_path / "g.csv").write_text("group_id,user_id,user_id_from,event,datetime\n1,2,,add,2024-01-01 00:00:00\nx,1,1,add,2024-01-01 00:00:00\n")
    rows = files.read_group_log(spark, str(tmp_path / "g.csv")).collect()
    assert rows[0]["user_id_from"] is None and rows[0]["event_dt"] == T0 and rows[1]["group_id"] is None


def test_partitioned_write_prunes(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', int(id % 3)) as load_date")
    files.write_parquet(df, path, partition_by=["load_date"])
    day = spark.read.parquet(path).where("load_date = date'2024-01-02'")
    assert day.count() == 33
    assert "PartitionFilters: [isnotnull(load_date" in plan(day)
    with pytest.raises(Exception):
        files.write_parquet(df, path)


def test_append_by_name(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.range(10).selectExpr("id as a", "id as b", "id as c")
    files.append_rows(df, path, ["b", "a"], max_rows_per_file=3)
    files.append_rows(df, path, ["b", "a"])
    assert spark.read.parquet(path).count() == 20


def test_labelled_files(spark, tmp_path):
    for label, n in (("Fear", 2), ("Happy", 3)):
        (tmp_path / label).mkdir()
        for i in range(n):
            (tmp_path / label / f"{i}.png").write_bytes(b"x" * (i + 1))
    found = files.read_labelled_files(spark, str(tmp_path), "*.png")
    assert {r["label"]: r["n"] for r in files.label_counts(found).collect()} == {"Fear": 2, "Happy": 3}
    assert [tuple(r) for r in files.class_indices(found).orderBy("index").collect()] == [("Fear", 0), ("Happy", 1)]


def test_scratch_is_the_named_folder(spark):
    folder = shared_folder(spark)
    assert new_path(spark, "x").startswith(folder.rstrip("/"))
    assert written(spark.range(3).toDF("id"), "rows").count() == 3

    class Unset:
        class conf:
            get = staticmethod(lambda key, default: {"spark.master": "local[2]"}.get(key, default))

    assert shared_folder(Unset) == shared_folder(Unset) != ""


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def note(*args, **kwargs):
            if name in ("option", "format"):
                key, value = args if name == "option" else ("format", args[0])
                self.told[key] = value
            elif name == "options":
                self.told.update(kwargs)
            else:
                self.told[name] = args
            return self
        return note


class FakeSession:
    def __init__(self):
        self.read = Recorder()
        self.readStream = Recorder()


def test_jdbc_and_kafka_options():
    session = FakeSession()
    jdbc.read_table(session, {"url": "u"}, "t", "id", 0, 100, 8)
    assert session.read.told == {"format": "jdbc", "url": "u", "dbtable": "t", "partitionColumn": "id", "lowerBound": 0,
                                 "upperBound": 100, "numPartitions": 8, "load": ()}
    kafka.read_topic(session, {"kafka.bootstrap.servers": "b"}, "in")
    assert session.readStream.told == {"format": "kafka", "kafka.bootstrap.servers": "b", "subscribe": "in", "load": ()}

    class Frame:
        write = Recorder()

        def select(self, *names):
            assert names == ("value",)
            return self

    jdbc.append_table(Frame, {"url": "u"}, "t")
    assert Frame.write.told == {"format": "jdbc", "url": "u", "dbtable": "t", "mode": ("append",), "save": ()}
    Frame.write = Recorder()
    kafka.write_topic(Frame(), {"o": "p"}, "out")
    assert Frame.write.told == {"format": "kafka", "o": "p", "topic": "out", "save": ()}


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text("size,id,more\n7,1,x\nbig,2,y\n8,3\n")
    path = str(tmp_path / "swapped.csv")
    rows = files.read_csv(spark, path, "id int, size int", keep_corrupt=True).collect()
    assert [(r["id"], r["size"]) for r in rows] == [(1, 7), (2, None), (3, 8)]
    assert [r[files.CORRUPT] is not None for r in rows] == [False, True, True]
    with pytest.raises(ValueError, match="other"):
        files.read_csv(spark, path, "id int, other int")


def test_group_log_with_its_time_named_otherwise(spark, tmp_path):
    (tmp_path / "log.csv").write_text("group_id,user_id,user_id_from,event,datetime\n1,2,,add,2024-01-05 10:00:00\n")
    row = files.read_group_log(spark, str(tmp_path / "log.csv")).first()
    assert (row["group_id"], row["user_id_from"], row["event"], str(row["event_dt"])) == (1, None, "add", "2024-01-05 10:00:00")


def test_a_file_with_another_header_is_refused(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("id,size\n1,7\n")
    (folder / "b.csv").write_text("id,size\n2,8\n")
    assert sorted(map(tuple, files.read_csv(spark, str(folder), "id int, size int").collect())) == [(1, 7), (2, 8)]
    (folder / "c.csv").write_text("size,id\n9,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(folder), "id int, size int").collect()


def test_a_load_is_published_once(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "loads")
    df = spark.range(10).selectExpr("id as a", "id as b")
    assert files.load_once(df, table, "day-1", ["a"]) and not files.load_once(df, table, "day-1", ["a"])
    assert spark.read.parquet(table).count() == 10

    def crash(*args):
        raise RuntimeError("lost between writing and publishing")

    with monkeypatch.context() as m:
        m.setattr(files, "publish", crash)
        with pytest.raises(RuntimeError):
            files.load_once(df, table, "day-2", ["a"])
    assert spark.read.parquet(table).count() == 10  # nothing of the broken load is read
    assert files.load_once(df, table, "day-2", ["a"]) and not files.load_once(df, table, "day-2", ["a"])
    assert sorted((r["load_id"], r["n"]) for r in spark.read.parquet(table).groupBy("load_id").agg(F.count("*").alias("n")).collect()) == [("day-1", 10), ("day-2", 10)]
    # two writers of one load: the second finds it published and leaves nothing
    hadoop = spark._jvm.org.apache.hadoop.fs
    final, late = hadoop.Path(f"{table}/load_id=day-2"), hadoop.Path(f"{table}/_staged/late")
    store = final.getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.parquet(f"{table}/_staged/late")
    assert not files.publish(store, late, final) and not store.exists(late)
    with pytest.raises(ValueError):
        files.load_once(df, table, "day/3")


def test_bitmaps_hold_exact_ids(spark):
    ids = [None, 0, 1, 7, 8, 32767, 32768, 32769, 65536, 10**9, 10**9, -1, -32768, -40000]
    rows = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "id bigint, g int")
    whole = warehouse.id_bitmaps(rows, "id")
    merged = warehouse.merge_bitmaps([warehouse.id_bitmaps(rows.where(f"g = {g}"), "id") for g in (0, 1)])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    by_g = {r["g"]: r["n"] for r in warehouse.bitmap_counts(warehouse.id_bitmaps(rows, "id", ["g"]), ["g"], "n").collect()}
    assert by_g == {g: len({i for k, i in enumerate(ids) if i is not None and k % 2 == g}) for g in (0, 1)}
    asked = spark.createDataFrame([(i,) for i in [*ids, 2, 9, 32766, 65535, -2, 10**9 + 1]], "id bigint")
    some = warehouse.id_bitmaps(rows.where("g = 0"), "id")
    there = {i for k, i in enumerate(ids) if k % 2 == 0 and i is not None}
    assert {r["id"] for r in warehouse.in_bitmaps(asked, some, "id").collect()} == there
    assert {r["id"] for r in warehouse.in_bitmaps(asked, some, "id", found=False).collect()} == {*ids, 2, 9, 32766, 65535, -2, 10**9 + 1} - there


def test_load_time_lies_between_two_clocks(spark):
    users = spark.createDataFrame([(1, T0)], "id int, registration_dt timestamp_ntz")
    log = spark.createDataFrame([(1,)], "user_id int")
    clock = lambda: spark.sql("select current_timestamp()::timestamp_ntz as t").first()["t"]
    before = clock()
    row = warehouse.load_hub(users, log, "user_id", "hk", "user_id").first()
    assert before <= row["load_dt"] <= clock() and row["load_src"] == "s3"
