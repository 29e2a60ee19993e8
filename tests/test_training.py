import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from milepost.operators.forest import prefix_scores
from milepost.plans import training


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(1200):
        x, c = rng.gauss(0, 1), rng.choice(["a", "b", None])
        y = 3 * x + (5 if c == "a" else 0) + rng.gauss(0, 0.1)
        data.append((i, x, rng.gauss(0, 1), c, y, int(y + rng.gauss(0, 1) > 1)))
    return spark.createDataFrame(data, "id int, x double, z double, c string, y double, t int").cache()


def spec(**changes):
    base = dict(key="id", label="y", numeric=["x", "z"], categories=["c"], scale=["x", "z"])
    return training.Spec(**(base | changes))


def test_split_is_stable_and_near_its_share(rows):
    train, test = training.split(rows, "id")
    again = training.split(rows.repartition(3), "id")[1]
    assert train.count() + test.count() == 1200
    assert 0.15 < test.count() / 1200 < 0.25
    assert test.exceptAll(again).count() == 0


def test_encoder_codes_and_population_scaling(spark, rows):
    coded = training.ordinal_encoder(["c"]).fit(rows).transform(rows)
    got = {r["c"]: r["c_code"] for r in coded.select("c", "c_code").distinct().collect()}
    assert got == {"a": 0.0, "b": 1.0, None: 2.0}
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, k double")
    scaled = training.Scaling.fit(df, ["x", "k"]).apply(df).collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_regression_comparison(rows):
    models = {"linear": training.linear_regression(), "forest": training.forest_regressor(10, 5), "boosted": training.boosted_regressor(10, 3)}
    table, fitted = training.train_compare(rows, spec(models=models))
    got = {r["model"]: r["rmse"] for r in table.collect()}
    assert set(got) == set(models) and got["boosted"] < 1.5 and got["forest"] < 1.8
    assert got["linear"] < 2.6


def test_classifier_comparison_and_importance(spark, rows):
    models = {"logistic": training.logistic_regression(1000), "forest": training.forest_classifier(10, 5)}
    table, fitted = training.train_compare(rows, spec(label="t", task="classification", models=models))
    for r in table.collect():
        assert r["accuracy"] > 0.75 and r["roc_auc"] > 0.8
    ranked = training.feature_importance(spark, fitted["forest"], ["x", "z", "c_code"]).collect()
    assert ranked[-1]["feature"] == "z" and sum(r["importance"] for r in ranked) == pytest.approx(1)


def test_grid_keeps_the_highest_accuracy_and_the_lowest_error(rows):
    data = training.prepare(rows, spec(label="t", task="classification"))
    table, model = training.cross_validate(
        training.with_fold(data.train, "id", 3), training.forest_classifier(), {"numTrees": [1, 8], "maxDepth": [1, 4]},
        task="classification", folds=3)
    got = table.collect()
    assert len(got) == 4
    best = [r for r in got if r["best"]]
    assert len(best) == 1 and best[0]["metric"] == max(r["metric"] for r in got)
    assert model.bestModel.getNumTrees == int(best[0]["numTrees"])
    line = training.prepare(rows, spec())
    table, _ = training.cross_validate(training.with_fold(line.train, "id", 5), training.linear_regression(), {"regParam": [0.0, 50.0]})
    assert [r["regParam"] for r in table.collect() if r["best"]] == [0.0]


def votes_one_tree_at_a_time(model, rows, classes):
    """Running votes of the single trees: (rows, trees, classes or 1)."""
    at = [r["features"] for r in rows]
    if classes:
        each = np.array([[np.array(t.predictRaw(x)) for t in model.trees] for x in at])
        each = each / each.sum(axis=2, keepdims=True)
    else:
        each = np.array([[[t.predict(x)] for t in model.trees] for x in at])
    return np.cumsum(each, axis=1)


@pytest.mark.parametrize("classes", [True, False])
def test_prefix_scores_are_those_of_the_first_trees(rows, classes):
    data = training.prepare(rows.limit(400), spec(**({"label": "t", "task": "classification"} if classes else {})))
    forest = training.forest_classifier(7, 6) if classes else training.forest_regressor(7, 6)
    model, test = forest.fit(data.train), data.test.collect()
    truth = np.array([r["label"] for r in test])
    votes = votes_one_tree_at_a_time(model, test, classes)
    got = {r["trees"]: (r["n"], r["miss"]) for r in prefix_scores(data.test.repartition(3), model, [1, 2, 5, 7], [6], classes).collect()}
    assert set(got) == {1, 2, 5, 7}
    for k, (n, miss) in got.items():
        said = votes[:, k - 1]
        want = (said.argmax(axis=1) != truth).sum() if classes else ((said[:, 0] / k - truth) ** 2).sum()
        assert n == len(truth) and miss == pytest.approx(want)
    whole = model.transform(data.test).collect()  # all trees: the forest's own prediction
    own = sum(r["prediction"] != r["label"] for r in whole) if classes else sum((r["prediction"] - r["label"]) ** 2 for r in whole)
    assert got[7][1] == pytest.approx(own)
    with pytest.raises(ValueError):
        prefix_scores(data.test, model, [8], [6], classes)


@pytest.mark.parametrize("classes", [True, False])
def test_a_cut_tree_is_the_tree_of_a_smaller_depth(rows, classes):
    """Without sampling, forests of any depth can be grown singly and must score as the cut one does."""
    data = training.prepare(rows.limit(500), spec(**({"label": "t", "task": "classification"} if classes else {})))
    grow = lambda d: (training.forest_classifier(2, d) if classes else training.forest_regressor(2, d)).setBootstrap(False).setFeatureSubsetStrategy("all").fit(data.train)
    got = {r["depth"]: r["miss"] for r in prefix_scores(data.test, grow(9), [2], [0, 1, 2, 4, 9], classes).collect()}
    for depth, miss in got.items():
        whole = grow(depth).transform(data.test).collect()
        own = sum(r["prediction"] != r["label"] for r in whole) if classes else sum((r["prediction"] - r["label"]) ** 2 for r in whole)
        assert miss == pytest.approx(own), depth


def test_forest_search_scores_the_whole_grid(rows):
    data = training.prepare(rows, spec(label="t", task="classification"))
    grid = {"numTrees": [1, 4, 9], "maxDepth": [1, 3]}
    table, model = training.search_forest(training.with_fold(data.train, "id", 3), training.forest_classifier(), grid, "classification", 3)
    got = table.collect()
    assert [(r["numTrees"], r["maxDepth"]) for r in got] == [(k, d) for k in (1, 4, 9) for d in (1, 3)]
    best = [r for r in got if r["best"]]
    assert len(best) == 1 and best[0]["metric"] == max(r["metric"] for r in got) > 0.8
    assert (model.getNumTrees, model.getMaxDepth()) == (best[0]["numTrees"], best[0]["maxDepth"])
    line = training.prepare(rows, spec())
    table, none = training.search_forest(training.with_fold(line.train, "id", 3), training.forest_regressor(), grid, folds=3, refit=False)
    got = table.collect()
    assert none is None and [r["metric"] for r in got if r["best"]] == [min(r["metric"] for r in got)]
    table, none = training.search_forest(training.with_fold(line.train, "id", 3).where("fold = 7"), training.forest_regressor(), grid, folds=0)
    assert [r["metric"] for r in table.collect()] == [None] * 6 and none is None


def test_baselines_of_the_split(spark, rows):
    flat = spark.createDataFrame([("m", 1.0, 0.9, 0.5)], "model string, rmse double, accuracy double, roc_auc double")
    train, test = training.split(rows, "id")
    mean = train.agg(F.avg("y")).first()[0]
    want = np.sqrt(np.mean([(r["y"] - mean) ** 2 for r in test.collect()]))
    got = training.against_baseline(rows, spec(), flat).first()
    assert got["baseline"] == pytest.approx(want) and got["n_test"] == test.count() and got["better"]
    share = [r["t"] for r in train.collect()]
    usual = int(sum(share) * 2 > len(share))
    got = training.against_baseline(rows, spec(label="t", task="classification"), flat).first()
    assert got["baseline"] == pytest.approx(np.mean([r["t"] == usual for r in test.collect()]))


def test_save_and_load(spark, rows, tmp_path):
    ready = rows.withColumn("label", F.col("y"))
    model = Pipeline(stages=[training.assemble(["x", "z"]), training.linear_regression()]).fit(ready)
    training.save_model(model, str(tmp_path / "m"))
    training.save_model(model, str(tmp_path / "m"))
    a = model.transform(ready).agg(F.sum("prediction")).first()[0]
    b = training.load_model(str(tmp_path / "m")).transform(ready).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b)


def test_score_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0]), (2, [3.0, 1.0])], "id int, v array<float>")

    def make():
        return lambda batch: np.stack([batch[:, 0], batch[:, 1] * 2], axis=1)

    got = {r["id"]: (list(r["probs"]), r["predicted"]) for r in training.score_vectors(df, "v", make).collect()}
    assert got == {1: ([0.0, 4.0], 1), 2: ([3.0, 2.0], 0)}


def test_a_column_with_too_many_labels_is_named(spark):
    rows = spark.range(500).selectExpr("id", "string(id) as wide", "string(id % 3) as narrow")
    training.check_labels(rows, ["narrow", "wide"])
    with pytest.raises(ValueError, match="wide"):
        training.check_labels(rows, ["narrow", "wide"], most=100)


def test_folds_and_models_are_fitted_together_and_rows_keep_their_nodes(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i % 11), (i % 7) * 3.0 + (i % 11)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y double").coalesce(1)
    models = {"linear": training.linear_regression(), "forest": training.forest_regressor(trees=4, depth=5)}
    spec = training.Spec("k", "y", ["a", "b"], models=models)
    train = training.with_fold(training.prepare(df, spec).train, "k", 3)
    ran, real = [], training.together
    monkeypatch.setattr(training, "together", lambda spark, run, items: ran.append(len(items)) or real(spark, run, items))
    table, fitted = training.train_compare(df, spec)
    assert list(fitted) == ["linear", "forest"] and {r["model"] for r in table.collect()} == {"linear", "forest"}
    assert fitted["linear"].coefficients.toArray().tolist() == pytest.approx([3.0, 1.0])
    grid = {"numTrees": [2, 4], "maxDepth": [1, 3]}
    found = [
        sorted(training.search_forest(train, training.forest_regressor().setCacheNodeIds(kept), grid, folds=3, refit=False)[0].collect())
        for kept in (True, False)
    ]
    assert found[0] == found[1] and len(found[0]) == 4
    assert ran == [2, 3, 3]
    assert all(f().getCacheNodeIds() for f in (training.forest_regressor, training.forest_classifier))

    def broken(_):
        raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        real(spark, broken, [1, 2])


def test_rows_are_stored_once_and_dealt_evenly_and_models_applied_once(spark, monkeypatch):
    """A comparison and its baseline read the rows of one write; parts are equal, and as many as tasks run at a time."""
    cells = [(i, float(i % 7), float(i % 11), (i % 7) * 3.0 + (i % 11)) for i in range(1000)]
    df = spark.createDataFrame(cells, "k int, a double, b double, y double").coalesce(1)
    assert training.dealt(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(training, "FEW_ROWS", 100)
    places = spark.sparkContext.defaultParallelism
    sizes = training.dealt(df).rdd.glom().map(len).collect()
    assert len(sizes) == places and max(sizes) - min(sizes) <= 10
    monkeypatch.setattr(training, "TASK_ROWS", 100)
    many = training.dealt(df)
    assert many.rdd.getNumPartitions() == places * -(-1000 // (places * 100)) and sorted(many.collect()) == sorted(df.collect())
    names, real = [], training.written
    monkeypatch.setattr(training, "written", lambda df, name: names.append(name) or real(df, name))
    spec = training.Spec("k", "y", ["a", "b"], models={"linear": training.linear_regression(), "forest": training.forest_regressor(4, 5)})
    rows = training.model_rows(df, spec)
    table, fitted = training.compare_rows(rows, spec)
    got = training.against_baseline(rows, spec, table)
    assert names[0] == "model-rows" and sorted(names[1:]) == ["scored", "scored"]
    assert [r["model"] for r in got.collect()] == ["linear", "forest"] == list(fitted) and all(r["better"] for r in got.collect())
    assert "UDF" not in got._jdf.queryExecution().toString()  # no model is applied again by the table
    assert fitted["linear"].coefficients.toArray().tolist() == pytest.approx([3.0, 1.0])


def test_folds_of_a_cross_validation_are_fitted_together(rows, monkeypatch):
    data = training.prepare(rows, spec(label="t", task="classification"))
    train = training.with_fold(data.train, "id", 3)
    ran, real = [], training.together
    monkeypatch.setattr(training, "together", lambda spark, run, items, *n: ran.append(len(items)) or real(spark, run, items, *n))
    learner = training.logistic_regression(1000)
    table, model = training.cross_validate(train, learner, {"elasticNetParam": [0.0]}, "classification", 3)
    right = []
    for fold in range(3):
        said = learner.fit(train.where(F.col("fold") != fold)).transform(train.where(F.col("fold") == fold)).collect()
        right.append(np.mean([r["prediction"] == r["label"] for r in said]))
    assert ran == [4]  # three folds and the model of all rows
    assert table.first()["metric"] == pytest.approx(np.mean(right)) == model.avgMetrics[0]
    assert model.stdMetrics[0] == pytest.approx(np.std(right)) and model.getNumFolds() == 3
    assert model.bestModel.coefficients.toArray().tolist() == pytest.approx(learner.fit(train).coefficients.toArray().tolist())
    with pytest.raises(ValueError, match="fold"):
        training.cross_validate(train, learner, {"elasticNetParam": [0.0]}, "classification", 2)
    with pytest.raises(ValueError, match="fold"):
        training.cross_validate(train, learner, {"elasticNetParam": [0.0]}, "classification", 4)
