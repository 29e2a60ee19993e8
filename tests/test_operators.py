import hashlib
import math
import random
import time
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost import schemas
from milepost.functions import scalars
from milepost.functions.statistics import md5_words, poisson_counts, poisson_steps, poisson_weight, student_p_value, uniform_from_hash, uniforms
from milepost.catalog import derive
from milepost.operators import evaluation, experiment, prepare, profile, quality, scratch
from milepost.operators.ordered import exact_percentiles, running_totals, with_bucket
from milepost.operators.skew import hot_keys, lookup_join, row_hash
from milepost.plans import cars, customers, payouts


def percentile(values, share):
    values = sorted(values)
    pos = share * (len(values) - 1)
    low = math.floor(pos)
    high = math.ceil(pos)
    return values[low] + (values[high] - values[low]) * (pos - low)


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_percentiles_of_a_crowded_group_and_a_tiny_one(spark, buckets):
    rng = random.Random(1)
    groups = {"hot": [rng.choice([1.0, 2.0, rng.gauss(0, 100)]) for _ in range(900)], "one": [5.0], None: [3.0, 4.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.975, 1.0]
    got = {(r["g"], r["share"]): (r["percentile"], r["n"]) for r in exact_percentiles(df, "v", shares, ["g"], buckets).collect()}
    assert len(got) == len(groups) * len(shares)
    for (g, s), (p, n) in got.items():
        assert p == pytest.approx(percentile(groups[g], s)) and n == len(groups[g])


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = random.Random(2)
    rows = [(rng.randrange(40), 1, rng.randrange(3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "x int, n long, m long")
    got = running_totals(df, "x", ["n", "m"], descending=descending, buckets=5).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        inside = [q for q in rows if (q[0] >= r["x"] if descending else q[0] <= r["x"])]
        assert (r["cum_n"], r["cum_m"]) == (len(inside), sum(q[2] for q in inside))


def test_running_totals_plan_sorts_no_whole_table(spark, plan):
    df = spark.range(1000).selectExpr("double(id) as x", "1L as n")
    text = plan(running_totals(df, "x", ["n"], buckets=8))
    # The only window without keys runs over the bucket totals.
    assert text.count("SinglePartition") == 1


def test_lookup_join_with_a_hot_key(spark):
    fact = spark.range(0, 3000, 1, 8).selectExpr("id", "int(if(id % 3 = 0, 1, id % 700)) as k")
    dim = spark.range(500).selectExpr("id as k", "concat('v', id) as v")
    hot = hot_keys(fact, ["k"], 150)
    assert [r.salts for r in hot.collect()] == [7]
    for how in ("left", "inner", "left_semi", "left_anti"):
        for salted in (hot, None, hot.where("false")):
            got = lookup_join(fact, dim, ["k"], how, hot=salted)
            want = fact.join(dim, "k", how)
            assert got.columns[:2] == ["id", "k"]
            assert got.count() == want.count()
            assert got.select(*want.columns).exceptAll(want).count() == 0
    right = dim.withColumn("k", F.when(F.col("k") != 5, F.col("k")))
    nulls = fact.withColumn("k", F.when(F.col("k") != 1, F.col("k")))
    got = lookup_join(nulls, right, ["k"], "left", null_safe=True, hot=hot_keys(nulls, ["k"], 150))
    assert got.count() == 3000 and got.where("k is null and v = 'v5'").count() == nulls.where("k is null").count()


@pytest.mark.parametrize(
    "t, df, p",
    [(12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (1.96, 10**9, 0.05), (2.576, 10**7, 0.01), (0.0, 5, 1.0)],
)
def test_student_table_values(t, df, p):
    assert student_p_value()(t, df) == pytest.approx(p, abs=2e-4)
    assert student_p_value()(-t, df) == pytest.approx(p, abs=2e-4)


def ab(spark, rows):
    return spark.createDataFrame(rows, "u int, c string, x double, y double")


def test_ab_edge_cases(spark):
    rows = [(1, "A", 1.0, 0.0), (2, "A", 3.0, 0.0), (3, "B", 5.0, 2.0)]
    got = {r["metric"]: r for r in experiment.ab_report(ab(spark, rows), "u", "c", ["x", "y"], "A", "B").collect()}
    assert (got["x"]["change_pct"], got["x"]["ratio_pct"]) == (25.0, 25.0)
    assert (got["y"]["a"], got["y"]["change_pct"], got["y"]["ratio_pct"]) == (0.0, None, None)
    back = {r["metric"]: r for r in experiment.ab_report(ab(spark, rows), "u", "c", ["y"], "B", "A").collect()}
    # B-side zero: the larger total itself is reported.
    assert (back["y"]["change_pct"], back["y"]["ratio_pct"]) == (-100.0, 2.0)
    same = ab(spark, [(i, "AB"[i % 2], 4.0, 1.0) for i in range(6)])
    flat = experiment.t_test(same, "c", ["x"], "A", "B").first()
    assert flat["t"] is None and flat["p_value"] is None and flat["significant"] is None


def test_t_is_independent_of_row_order(spark):
    rng = random.Random(4)
    rows = [(i, "AB"[i % 2], rng.gauss(0, 1), 0.0) for i in range(200)]
    one = experiment.t_test(ab(spark, rows), "c", ["x"], "A", "B").first()
    two = experiment.t_test(ab(spark, rows[::-1]).repartition(5), "c", ["x"], "A", "B").first()
    assert one["t"] == pytest.approx(two["t"]) and one["df"] == 198


def test_poisson_weights(spark):
    steps = poisson_steps()
    assert steps[:4] == pytest.approx([0.36787944, 0.73575888, 0.91969860, 0.98101184], abs=1e-8)
    drawn = spark.range(40000).select(poisson_weight(uniform_from_hash(F.col("id"), F.lit(1))).alias("w"))
    row = drawn.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v")).first()
    assert row["m"] == pytest.approx(1, abs=0.03) and row["v"] == pytest.approx(1, abs=0.05)


def test_bootstrap_interval_holds_the_difference(spark):
    rng = random.Random(6)
    rows = [(i, "AB"[i % 2], rng.gauss(10 + i % 2, 2), 0.0) for i in range(2000)]
    draws = experiment.bootstrap_differences(ab(spark, rows), "u", "c", "x", "A", "B", 200)
    assert draws.count() == 200
    ci = experiment.bootstrap_interval(draws).first()
    assert 0.7 < ci["ci_low"] < ci["ci_high"] < 1.3


def test_bootstrap_sums_equal_one_row_at_a_time(spark, plan, monkeypatch):
    """Any block of rows and replicates gives the sums of single weights; rows are not multiplied by replicates."""
    rng = random.Random(9)
    rows = [(i, "AB"[i % 2] if i % 7 else "C", rng.gauss(5, 2) if i % 5 else None, 0.0) for i in range(60)]
    monkeypatch.setattr(experiment, "BOOTSTRAP_ROWS", 7)
    monkeypatch.setattr(experiment, "BOOTSTRAP_REPLICATES", 4)
    draws = experiment.bootstrap_differences(ab(spark, rows), "u", "c", "x", "A", "B", 11, "md5")
    assert "Generate" not in plan(draws) and "Expand" not in plan(draws)
    got = {r["replicate"]: r["difference"] for r in draws.collect()}
    for b in range(1, 12):
        sums = {"A": [0.0, 0], "B": [0.0, 0]}
        for u, c, x, _ in rows:
            if c in sums and x is not None:
                number = int(hashlib.md5(f"{u}|{b}".encode()).hexdigest()[:8], 16) / 2**32
                k = sum(number >= edge for edge in poisson_steps())
                sums[c][0] += k * x
                sums[c][1] += k
        assert got[b] == pytest.approx(sums["B"][0] / sums["B"][1] - sums["A"][0] / sums["A"][1])
    assert set(got) == set(range(1, 12))
    few = experiment.bootstrap_differences(ab(spark, [(1, "A", 1.0, 0.0)]), "u", "c", "x", "A", "B", 3)
    assert [r["difference"] for r in few.collect()] == [None] * 3


def test_drawn_weights_are_poisson():
    seeds = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 400)
    for drawn in (uniforms("hash")(seeds, np.arange(1, 301)), uniforms("md5")([str(s) for s in seeds], np.arange(1, 301))):
        counts = poisson_counts()(drawn)
        assert counts.mean() == pytest.approx(1, abs=0.02) and counts.var() == pytest.approx(1, abs=0.03)
        assert abs(np.corrcoef(counts[:, 0], counts[:, 1])[0, 1]) < 0.2 and abs(np.corrcoef(counts[0], counts[1])[0, 1]) < 0.2


def test_modes_ties_and_all_null_group(spark):
    rows = [("a", "x"), ("a", "y"), ("a", None), ("b", None), ("c", "z"), (None, "q"), (None, None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert {r["k"]: r["v"] for r in prepare.group_modes(df, ["v"], ["k"]).collect()} == {"a": "x", "c": "z", None: "q"}
    filled = prepare.impute_by_group(df, {"v": "mode"}, ["k"])
    assert sorted((str(r["k"]), str(r["v"])) for r in filled.collect()) == sorted(
        [("a", "x"), ("a", "y"), ("a", "x"), ("b", "None"), ("c", "z"), ("None", "q"), ("None", "q")])


def test_numeric_modes_tie_by_number(spark):
    df = spark.createDataFrame([("a", 10, "x"), ("a", 9, "x")], "k string, v int, w string")
    assert prepare.group_modes(df, ["v"], ["k"]).first()["v"] == 9
    assert tuple(prepare.group_modes(df, ["v", "w"], ["k"]).first()) == ("a", 9, "x")


def test_salted_lookup_refuses_to_repeat_the_dimension(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(2), spark.range(2), ["id"], "full")


def test_clean_adverts(spark):
    columns = ["Price", "VehicleType", "RegistrationYear", "Gearbox", "Power", "Model", "Kilometer", "RegistrationMonth", "FuelType", "Brand", "NotRepaired"]
    rows = [
        (100, "suv", 2000, "auto", 100, "m1", 1, 1, "petrol", "b", None),
        (100, "suv", 2000, "auto", 120, "m1", 1, 1, "petrol", "b", "yes"),
        (100, None, 2000, None, 0, None, 1, 1, None, "b", "no"),
        (100, "bus", 2000, "auto", 0, "samara", 1, 1, "petrol", "lada", "no"),
        (100, "bus", 2000, "auto", 0, "601", 1, 1, "petrol", "trabant", "no"),
        (0, "bus", 2000, "auto", 50, "m", 1, 1, "petrol", "b", "no"),
        (100, "bus", 1979, "auto", 50, "m", 1, 1, "petrol", "b", "no"),
        (100, "bus", 2017, "auto", 50, "m", 1, 1, "petrol", "b", "no"),
        (100, "bus", 2000, "auto", 1000, "m", 1, 1, "petrol", "b", "no"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c in ('Price', 'RegistrationYear', 'Power', 'Kilometer', 'RegistrationMonth') else 'string'}" for c in columns))
    for extra in ("DateCreated", "DateCrawled", "LastSeen", "NumberOfPictures", "PostalCode"):
        df = df.withColumn(extra, F.lit("1"))
    out = cars.clean_adverts(df).collect()
    assert len(out) == 5
    gap = next(r for r in out if r["brand"] == "b" and r["power"] not in (120.0,) and r["notrepaired"] == "no")
    assert (gap["model"], gap["vehicletype"], gap["gearbox"], gap["fueltype"], gap["power"]) == ("m1", "suv", "auto", "petrol", 100.0)
    assert {r["brand"]: r["power"] for r in out if r["brand"] != "b"} == {"lada": 76.5, "trabant": 26.0}
    assert "datecreated" not in out[0].asDict()


def test_profile_pieces(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (1, 2.0, "a"), (2, None, None)], "i int, d double, s string")
    assert profile.duplicate_count(df).first()[0] == 1
    assert profile.duplicate_count(df, ["i"]).first()[0] == 1
    assert {r["column"]: r["nulls"] for r in profile.null_profile(df).collect()} == {"i": 0, "d": 1, "s": 1}
    got = {r["column"]: (r["type"], r["n"], r["non_null"], r["distinct_values"]) for r in profile.table_profile(df).collect()}
    assert got == {"i": ("int", 3, 3, 2), "d": ("double", 3, 2, 1), "s": ("string", 3, 2, 1)}
    assert [r["n"] for r in profile.value_counts(df, "s").collect()] == [2]
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [tuple(r)[0::3] for r in profile.histogram(flat, "x", 4).collect()] == [(0, 2)]
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0


def test_histogram_top_edge(spark):
    df = spark.range(11).selectExpr("double(id) as x")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    df = spark.createDataFrame([(1, 1, 5), (1, 3, -1), (None, None, None)], "id int, ref int, v int")
    got = {r["rule"]: r["violations"] for r in quality.check_table(
        df, "t", not_null=["id"], rules={"v non-negative": F.col("v") >= 0}, unique=[["id"]], references=[("ref", parent, "id")]).collect()}
    assert got == {"id not null": 1, "v non-negative": 1, "id unique": 1, "ref references parent": 1}


def test_class_report_edge_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 0)], "t int, p int")
    got = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in evaluation.class_report(df, "t", "p").collect()}
    assert got == {0: (0.5, 0.5, 2), 1: (0.0, 0.0, 0), 2: (0.0, 0.0, 1)}


def test_auc_ties_and_one_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, t int")
    assert evaluation.roc_auc(df, "s", "t").first()["auc"] == pytest.approx(0.875)
    assert evaluation.roc_auc(df.where("t = 1"), "s", "t").first()["auc"] is None


@pytest.mark.parametrize(
    "rate, amount, want",
    [("3.9", "1000", 100), ("3.9", "10000", 500), ("4.0", "1000", 150), ("4.4", "10000", 700), ("4.5", "100", 175),
     ("4.9", "1000", 800), ("5.0", "1000", 200), ("5.0", "10000", 1000), (None, "1000", None)],
)
def test_payout_bands(spark, rate, amount, want):
    df = spark.createDataFrame([(Decimal(amount), rate and Decimal(rate))], "s decimal(14,2), r decimal(3,1)")
    got = df.select(payouts.payout(F.col("s"), F.col("r"))).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_ledger_keeps_the_contract(spark):
    deliveries = spark.createDataFrame(
        [("o1", 1, 5, Decimal("4.0"), Decimal("1000.00"), Decimal("10.00")), ("o2", 1, 5, Decimal("5.0"), Decimal("100.00"), Decimal("0.00")),
         ("o3", 9, 5, Decimal("5.0"), Decimal("1.00"), Decimal("0.00")), ("o4", 1, 6, None, Decimal("100.00"), Decimal("0.00"))],
        "order_id string, courier_id bigint, timestamp_id bigint, rate decimal(3,1), sum decimal(14,2), tip_sum decimal(14,2)")
    couriers = spark.createDataFrame([(1, "c1", "Ann")], schemas.COURIERS)
    stamps = spark.createDataFrame([(5, 2024, 1), (6, 2024, 2)], "id bigint, year smallint, month smallint")
    ledger = payouts.courier_ledger(deliveries, couriers, stamps)
    assert ", ".join(f"{c} {t}" for c, t in ledger.dtypes) == schemas.COURIER_LEDGER
    got = {r["settlement_month"]: r for r in ledger.collect()}
    row = got[1]
    assert (row["courier_name"], row["orders_count"], row["orders_total_sum"], row["rate_avg"]) == ("Ann", 2, Decimal("1100.00"), Decimal("4.50"))
    assert (row["order_processing_fee"], row["courier_order_sum"], row["courier_reward_sum"]) == (Decimal("275.00"), Decimal("350.00"), Decimal("342.00"))
    assert got[2]["rate_avg"] is None and got[2]["courier_order_sum"] is None


def test_scalars(spark):
    df = spark.createDataFrame([("1,5", " ", "2020-02-01"), ("x", "2.5", "bad")], "a string, b string, c string")
    out = df.select(scalars.decimal_comma(F.col("a")), scalars.lenient_double(F.col("b")), scalars.parse_date(F.col("c")).cast("string")).collect()
    assert [tuple(r) for r in out] == [(1.5, None, "2020-02-01"), (None, 2.5, None)]
    one = spark.range(1).select(
        scalars.weekday_name(F.lit("2024-01-03").cast("date")), scalars.first_day_of_week(F.lit("2024-01-03").cast("date")).cast("string"),
        scalars.first_day_of_month(F.lit("2024-01-03").cast("date")).cast("string"), scalars.ratio(F.lit(1), F.lit(3)), scalars.ratio(F.lit(1), F.lit(0)),
        scalars.arg_max(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))), scalars.moment_id(F.lit("1970-01-02 00:00:01.5").cast("timestamp_ntz")),
        scalars.hash_key(F.lit(1), F.lit("a")),
    ).first()
    key = hashlib.md5(b"1|a").hexdigest()
    assert tuple(one) == ("Wednesday", "2024-01-01", "2024-01-01", 0.33, None, 1, 86401500000, key)


def test_customer_view_full_outer(spark):
    contract = spark.createDataFrame(
        [("1", "2019-12-01", "No", "x", "Yes", "p", 10.0, " "), ("2", "2019-12-01", "2020-01-01 00:00:00", "x", "No", "p", 5.0, "7.5")],
        "customerID string, BeginDate string, EndDate string, Type string, PaperlessBilling string, PaymentMethod string, MonthlyCharges double, TotalCharges string")
    personal = spark.createDataFrame([("1", "Male", 0, "Yes", "No")], "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string")
    internet = spark.createDataFrame([("3", "DSL")], "customerID string, InternetService string")
    phone = spark.createDataFrame([("1", "Yes")], "customerID string, MultipleLines string")
    got = {r["customerID"]: r for r in customers.customer_view(contract, personal, internet, phone).collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"]["is_active"], got["1"]["DaysInside"], got["1"]["TotalCharges"], got["1"]["Day"]) == (1, 62, 0.0, "Sunday")
    assert (got["2"]["is_active"], got["2"]["DaysInside"], got["2"]["TotalCharges"], got["2"]["gender"]) == (0, 31, 7.5, "No")
    assert (got["3"]["MultipleLines"], got["3"]["MonthlyCharges"]) == ("No", None)


def test_salts_follow_the_rows_of_a_key(spark):
    """Half of all rows in one key, and many keys just under the limit: no part is much over it."""
    fact = spark.range(0, 40_000, 1, 8).selectExpr("id", "if(id % 2 = 0, -1L, id % 200) as k")
    hot = hot_keys(fact, ["k"], 500)
    salts = {r.hot: r.salts for r in hot.collect()}
    assert list(salts.values()) == [40]
    part = F.pmod(row_hash(fact.columns), F.when(F.col("k") == -1, F.lit(40)).otherwise(F.lit(1)))
    most = fact.groupBy("k", part.alias("p")).count().agg(F.max("count")).first()[0]
    assert most < 2 * 500


def test_histogram_has_every_bin(spark):
    values = spark.createDataFrame([(0.0,), (10.0,), (None,)], "x double")
    rows = profile.histogram(values, "x", bins=5).orderBy("bin").collect()
    assert [(r["bin"], r["lower"], r["n"]) for r in rows] == [(0, 0.0, 1), (1, 2.0, 0), (2, 4.0, 0), (3, 6.0, 0), (4, 8.0, 1)]
    assert [r["n"] for r in profile.histogram(values.where("x > 99"), "x", 3, 0, 9).orderBy("bin").collect()] == [0, 0, 0]
    assert profile.histogram(values.where("x > 99"), "x", 3).count() == 0
    assert profile.histogram(values.where("x = 10"), "x", 3).collect()[0]["n"] == 1


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert sorted(map(tuple, profile.table_profile(empty).collect())) == [("a", "int", 0, 0, 0), ("b", "string", 0, 0, 0)]


def test_percentiles_rank_in_the_own_type(spark):
    big = 2**53
    rows = spark.createDataFrame([(big + k,) for k in (1, 3, 2, 0, 4)], "x bigint")
    assert exact_percentiles(rows, "x", [0.5]).first()["percentile"] == float(big + 2)
    decimals = rows.selectExpr("cast(x - 9007199254740992 as decimal(20,4)) / 3 as x")
    assert abs(exact_percentiles(decimals, "x", [0.25]).first()["percentile"] - 1 / 3) < 1e-6


def test_buckets_follow_the_rows(spark):
    rows = spark.range(4_000).selectExpr("double(id) as x")
    cut = with_bucket(rows, "x", 40)
    sizes = [r["count"] for r in cut.groupBy("bucket").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 300
    assert with_bucket(rows.where("x < 0"), "x").count() == 0


def test_shared_folder_is_asked_for_off_this_machine():
    class Conf(dict):
        pass

    class Session:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    assert scratch.shared_folder(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "s3a://x/y"})) == "s3a://x/y"
    assert scratch.shared_folder(Session(**{"spark.master": "local[8]"}))
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError):
            scratch.shared_folder(Session(**{"spark.master": master}))


def test_body_modes_count_adverts_with_unsound_power(spark):
    """Three strong SUVs and two weak buses: the gap is an SUV, as the power limit comes later."""
    columns = [f.name for f in derive.adverts(spark, "/root/testdata/sf0.001").schema.fields]
    base = derive.adverts(spark, "/root/testdata/sf0.001").where("price > 0").limit(1).first().asDict()
    made = []
    for k, (body, power) in enumerate([("suv", 1500)] * 3 + [("bus", 90)] * 2 + [(None, 90)]):
        row = {c.lower(): v for c, v in base.items()}
        row.update(vehicletype=body, power=power, model="m", brand="b", registrationyear=2000, price=100, advert_id=k, gearbox="auto", fueltype="petrol")
        made.append(tuple(row[c.lower()] for c in columns))
    schema = derive.adverts(spark, "/root/testdata/sf0.001").schema
    out = {r["advert_id"]: r["vehicletype"] for r in cars.clean_adverts(spark.createDataFrame([tuple(float(v) if f.dataType.simpleString() == "double" and v is not None else v for f, v in zip(schema.fields, m)) for m in made], schema)).collect()}
    assert out == {3: "bus", 4: "bus", 5: "suv"}


def test_digests_of_blocks_equal_hashlib_and_are_cheaper():
    draw, rng = uniforms("md5"), random.Random(3)
    seeds = [str(rng.randrange(10 ** rng.randrange(1, 19))) for _ in range(300)] + [None, "", "é|x", "-7", "9" * 50, "9" * 54, "long " * 30]
    numbers = [1, 9, 10, 99, 100, 1000, 123456]
    want = [[int(hashlib.md5(f"{s or ''}|{r}".encode()).hexdigest()[:8], 16) / 2**32 for r in numbers] for s in seeds]
    assert draw(seeds, np.array(numbers)).tolist() == want
    assert draw([], np.array(numbers)).shape == (0, 7) and draw(seeds, np.array([], int)).shape == (307, 0)
    edges = [0.0, *poisson_steps(), 1 - 2.0**-32]
    assert poisson_counts()(np.array(edges)).tolist() == np.searchsorted(poisson_steps(), edges, side="right").tolist()
    heads, tails = [b"%d" % i for i in range(10_000, 11_000)], [b"|%d" % r for r in range(100, 400)]

    def one_by_one(heads, tails):
        return [hashlib.md5(h + t).digest()[:4] for h in heads for t in tails]

    def seconds(run):
        begun = time.process_time()
        run(heads, tails)
        return time.process_time() - begun

    assert min(seconds(md5_words()) for _ in range(3)) < seconds(one_by_one) / 2
