"""Encoding, scaling, training, scoring and evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from milepost.catalog import derive
from milepost.catalog.prepare import ADVERT_SQL
from milepost.catalog.registry import load, query, rounded
from milepost.functions.scalars import arg_max
from milepost.operators import evaluation
from milepost.operators.scratch import new_path
from milepost.plans import cars, customers, training


@query(
    "ordinal_encode",
    f"""WITH {derive.PARTS_SQL}, d AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
      FROM (SELECT DISTINCT p_type FROM parts WHERE p_type IS NOT NULL))
    SELECT p_partkey, CAST(coalesce(code, (SELECT count(*) FROM d)) AS INTEGER) AS code
    FROM parts LEFT JOIN d ON parts.p_type = d.p_type""",
)
def ordinal_encode(spark, sf_dir):
    parts = derive.gappy_parts(spark, sf_dir)
    coded = training.ordinal_encoder(["p_type"]).fit(parts).transform(parts)
    return coded.select("p_partkey", F.col("p_type_code").cast("int").alias("code"))


@query(
    "standard_scale",
    """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) + 0.0e0 AS p_size,
      round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) + 0.0e0 AS p_retailprice
    FROM part""",
)
def standard_scale(spark, sf_dir):
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    columns = ["p_size", "p_retailprice"]
    return rounded(training.Scaling.fit(parts, columns).apply(parts), columns, 6)


def _part_sql(seed: int, key: str, parts: int) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}|' || {key}), 1, 8)) AS BIGINT) % {parts})"


@query(
    "train_test_split",
    f"""SELECT CASE WHEN {_part_sql(0, 'o_orderkey', 100)} < 20 THEN 'test' ELSE 'train' END AS part,
      count(*) AS n FROM orders GROUP BY 1""",
)
def train_test_split(spark, sf_dir):
    train, test = training.split(load(spark, sf_dir, "orders"), "o_orderkey")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("part"), "n"
    )
    return count(train, "train").unionByName(count(test, "test"))


@query(
    "linear_regression_rmse",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
    SELECT round(sqrt(avg((l_extendedprice - a * l_quantity - b) * (l_extendedprice - a * l_quantity - b))), 3) + 0.0e0 AS rmse,
      round(avg(a * l_quantity + b), 3) + 0.0e0 AS mean_prediction
    FROM lineitem, f""",
)
def linear_regression_rmse(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"), "l_quantity"
    )
    ready = training.assemble(["l_quantity"]).transform(rows)
    model = training.linear_regression().fit(ready)
    out = evaluation.rmse(model.transform(ready), "label", "prediction")
    return rounded(out, ["rmse", "mean_prediction"], 3)


def _price_rows(spark, sf_dir):
    """Clean adverts whose price follows age and mileage, written; the retail price alone follows nothing that an advert says."""
    adverts = cars.clean_adverts(derive.adverts(spark, sf_dir))
    dearer = F.col("price") + 100 * (F.col("registrationyear") - 1980) - (F.col("kilometer") / 1000).cast("int")
    spec = cars.price_spec("advert_id", training.price_models())
    return training.model_rows(adverts.withColumn("price", dearer), spec), spec


def _churn_rows(spark, sf_dir):
    view = customers.model_rows(customers.customer_view(*derive.telecom(spark, sf_dir)))
    rows = training.model_rows(view, customers.churn_spec(view, {}))
    return rows, customers.churn_spec(view, training.churn_models(rows.count()))


@query("price_model_comparison")
def price_model_comparison(spark, sf_dir):
    """Hold-out error and mean prediction of the three regressors with their own settings."""
    table, _ = training.compare_rows(*_price_rows(spark, sf_dir))
    return table


@query("churn_model_comparison")
def churn_model_comparison(spark, sf_dir):
    """Hold-out accuracy and area of the three classifiers with their own settings."""
    table, _ = training.compare_rows(*_churn_rows(spark, sf_dir))
    return table


_PRICE_SPLIT_SQL = f"""{ADVERT_SQL},
  s AS (SELECT price + 100 * (registrationyear - 1980) - kilometer // 1000 AS price, {_part_sql(0, 'advert_id', 100)} < 20 AS held_out FROM sound),
  c AS (SELECT avg(price) AS mean FROM s WHERE NOT held_out),
  b AS (SELECT count(*) AS n_test, sqrt(avg((price - mean) * (price - mean))) AS baseline FROM s, c WHERE held_out)"""
_CHURN_SPLIT_SQL = f"""{derive.TELECOM_SQL},
  s AS (SELECT is_active, {_part_sql(0, 'customerID', 100)} < 20 AS held_out FROM view_),
  c AS (SELECT is_active AS usual FROM s WHERE NOT held_out GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  b AS (SELECT count(*) AS n_test, avg(CASE WHEN is_active = usual THEN 1.0e0 ELSE 0.0e0 END) AS baseline FROM s, c WHERE held_out)"""


@query(
    "price_models_beat_mean",
    f"""WITH {_PRICE_SPLIT_SQL}
    SELECT unnest(['boosted', 'forest', 'linear']) AS model, n_test, round(baseline, 3) + 0.0e0 AS baseline, true AS better FROM b""",
)
def price_models_beat_mean(spark, sf_dir):
    """Whether each regressor's error on the test rows is below that of the training rows' mean."""
    rows, spec = _price_rows(spark, sf_dir)
    table, _ = training.compare_rows(rows, spec)
    out = training.against_baseline(rows, spec, table)
    return rounded(out.select("model", "n_test", "baseline", "better"), ["baseline"], 3)


@query(
    "churn_models_beat_usual",
    f"""WITH {_CHURN_SPLIT_SQL}
    SELECT unnest(['boosted', 'forest', 'logistic']) AS model, n_test, round(baseline, 6) + 0.0e0 AS baseline, true AS better,
      true AS ranks FROM b""",
)
def churn_models_beat_usual(spark, sf_dir):
    """Whether each classifier names the test rows no worse than the usual label does, and ranks them better than chance."""
    rows, spec = _churn_rows(spark, sf_dir)
    table, _ = training.compare_rows(rows, spec)
    out = training.against_baseline(rows, spec, table)
    return rounded(out.select("model", "n_test", "baseline", "better", (F.col("roc_auc") > 0.5).alias("ranks")), ["baseline"], 6)


@query("churn_importance")
def churn_importance(spark, sf_dir):
    rows, spec = _churn_rows(spark, sf_dir)
    data = training.prepare_rows(rows, spec)
    model = training.forest_classifier().fit(data.train)
    return training.feature_importance(spark, model, data.features)


@query("cv_grid")
def cv_grid(spark, sf_dir):
    """The whole churn grid, 20 numbers of trees by 4 depths: accuracy over three folds."""
    rows, spec = _churn_rows(spark, sf_dir)
    train = training.with_fold(training.prepare_rows(rows, spec).train, spec.key, 3)
    table, _ = training.search_forest(
        train, training.forest_classifier(), training.CHURN_FOREST_GRID, task="classification", folds=3, refit=False
    )
    return table


@query("cv_price_grid")
def cv_price_grid(spark, sf_dir):
    """The whole price grid, 3 numbers of trees by 5 depths: error over three folds."""
    rows, spec = _price_rows(spark, sf_dir)
    train = training.with_fold(training.prepare_rows(rows, spec).train, spec.key, 3)
    table, _ = training.search_forest(train, training.forest_regressor(), training.PRICE_FOREST_GRID, folds=3, refit=False)
    return table


@query("cv_logistic")
def cv_logistic(spark, sf_dir):
    """Five-fold accuracy of the logistic churn model."""
    rows, spec = _churn_rows(spark, sf_dir)
    train = training.with_fold(training.prepare_rows(rows, spec).train, spec.key, 5)
    model = training.logistic_regression(train.count())
    table, _ = training.cross_validate(train, model, {"elasticNetParam": [0.0]}, task="classification")
    return table


@query("cv_linear")
def cv_linear(spark, sf_dir):
    """Five-fold error of the linear price model."""
    adverts = cars.clean_adverts(derive.adverts(spark, sf_dir))
    spec = cars.price_spec("advert_id", {})
    train = training.with_fold(training.prepare(adverts, spec).train, spec.key, 5)
    table, _ = training.cross_validate(train, training.linear_regression(), {"regParam": [0.0]})
    return table


@query(
    "cv_one_feature",
    f"""WITH r AS (SELECT o_totalprice AS y, o_custkey AS x, {_part_sql(1, 'o_orderkey', 5)} AS fold FROM orders),
    fit AS (SELECT f, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
      FROM r, range(5) k(f) WHERE fold <> f GROUP BY f),
    err AS (SELECT f, sqrt(avg((y - a * x - b) * (y - a * x - b))) AS e FROM r JOIN fit ON fold = f GROUP BY f)
    SELECT 0.0e0 AS "regParam", round(avg(e), 2) + 0.0e0 AS metric, true AS best FROM err""",
)
def cv_one_feature(spark, sf_dir):
    """Five-fold error of a line through the orders."""
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("label")
    )
    folded = training.with_fold(training.assemble(["o_custkey"]).transform(rows), "o_orderkey", 5)
    table, _ = training.cross_validate(folded, training.linear_regression(), {"regParam": [0.0]})
    return rounded(table, ["metric"], 2)


@query(
    "model_round_trip",
    """WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS a, regr_intercept(o_totalprice, o_custkey) AS b FROM orders)
    SELECT o_orderkey, round(a * o_custkey + b, 2) + 0.0e0 AS prediction FROM orders, f""",
)
def model_round_trip(spark, sf_dir):
    """Fit, save, load and apply."""
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("label")
    )
    steps = [training.assemble(["o_custkey"]), training.linear_regression()]
    path = new_path(spark, "model")
    training.save_model(Pipeline(stages=steps).fit(rows), path)
    scored = training.load_model(path).transform(rows)
    return rounded(scored.select("o_orderkey", "prediction"), ["prediction"], 2)


_TRUTH_SQL = """t AS (
  SELECT d.doc_id, n_chars AS score, quality AS truth, CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END AS predicted
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def _judged(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        load(spark, sf_dir, "labels"), "doc_id"
    ).select(
        "doc_id",
        F.col("n_chars").alias("score"),
        F.col("quality").alias("truth"),
        F.when(F.col("n_chars") % 3 == 0, 1).otherwise(0).alias("predicted"),
    )


@query(
    "roc_auc",
    f"""WITH {_TRUTH_SQL},
    r AS (SELECT truth, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score)
        + count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS avg_rank FROM t),
    s AS (SELECT count(*) FILTER (WHERE truth = 1) AS p, count(*) FILTER (WHERE truth = 0) AS n,
        sum(avg_rank) FILTER (WHERE truth = 1) AS ranks FROM r)
    SELECT p AS positives, n AS negatives,
      round((ranks - p * (p + 1) / 2.0e0) / (p * n), 6) + 0.0e0 AS auc FROM s""",
)
def roc_auc(spark, sf_dir):
    return rounded(evaluation.roc_auc(_judged(spark, sf_dir), "score", "truth"), ["auc"], 6)


@query(
    "pr_curve",
    f"""WITH {_TRUTH_SQL},
    g AS (SELECT score, sum(truth) AS pos, count(*) AS n FROM t GROUP BY score),
    c AS (SELECT score, sum(pos) OVER w AS tp, sum(n) OVER w AS said, sum(pos) OVER () AS p
      FROM g WINDOW w AS (ORDER BY score DESC))
    SELECT CAST(score AS DOUBLE) AS threshold, round(tp / said, 6) + 0.0e0 AS precision,
      round(tp / p, 6) + 0.0e0 AS recall FROM c""",
)
def pr_curve(spark, sf_dir):
    curve = evaluation.precision_recall_curve(_judged(spark, sf_dir), "score", "truth")
    return rounded(curve, ["precision", "recall"], 6)


@query(
    "confusion",
    f"WITH {_TRUTH_SQL} SELECT truth, predicted, count(*) AS n FROM t GROUP BY truth, predicted",
)
def confusion(spark, sf_dir):
    return evaluation.confusion(_judged(spark, sf_dir), "truth", "predicted")


@query(
    "accuracy",
    f"""WITH {_TRUTH_SQL} SELECT count(*) AS n, count(*) FILTER (WHERE truth <> predicted) AS errors,
      round(avg(CASE WHEN truth = predicted THEN 1.0e0 ELSE 0 END), 6) + 0.0e0 AS accuracy FROM t""",
)
def accuracy(spark, sf_dir):
    return rounded(evaluation.accuracy(_judged(spark, sf_dir), "truth", "predicted"), ["accuracy"], 6)


_REPORT_SQL = """SELECT c AS class, round(coalesce(hit / nullif(said, 0), 0), 6) + 0.0e0 AS precision,
  round(coalesce(hit / nullif(support, 0), 0), 6) + 0.0e0 AS recall,
  round(coalesce(2.0e0 * hit / nullif(said + support, 0), 0), 6) + 0.0e0 AS f1, support FROM (
  SELECT c, count(*) FILTER (WHERE truth = c AND predicted = c) AS hit, count(*) FILTER (WHERE predicted = c) AS said,
    count(*) FILTER (WHERE truth = c) AS support
  FROM t, (SELECT DISTINCT truth AS c FROM t UNION SELECT DISTINCT predicted FROM t) GROUP BY c)"""


@query("class_report", f"WITH {_TRUTH_SQL} {_REPORT_SQL}")
def class_report(spark, sf_dir):
    out = evaluation.class_report(_judged(spark, sf_dir), "truth", "predicted")
    return rounded(out, ["precision", "recall", "f1"], 6)


_ARG_MAX_SQL = "list_position(embedding, list_max(embedding)) - 1"


@query(
    "argmax_class",
    f"SELECT vec_id, CAST({_ARG_MAX_SQL} AS INTEGER) AS predicted FROM embeddings",
)
def argmax_class(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", arg_max(F.col("embedding")).alias("predicted")
    )


@query(
    "vector_class_report",
    f"""WITH t AS (SELECT label AS truth, CAST(({_ARG_MAX_SQL}) % 10 AS INTEGER) AS predicted FROM embeddings)
    {_REPORT_SQL}""",
)
def vector_class_report(spark, sf_dir):
    """Ten classes, arg-max of a vector taken as the prediction."""
    rows = load(spark, sf_dir, "embeddings").select(
        F.col("label").alias("truth"), (arg_max(F.col("embedding")) % 10).alias("predicted")
    )
    return rounded(evaluation.class_report(rows, "truth", "predicted"), ["precision", "recall", "f1"], 6)


@query(
    "score_vectors",
    """WITH s AS (SELECT vec_id, list_sum([CAST(x AS DOUBLE) FOR x IN embedding[1:20]]) AS a,
        list_sum([CAST(x AS DOUBLE) FOR x IN embedding[21:40]]) AS b,
        list_sum([CAST(x AS DOUBLE) FOR x IN embedding[41:60]]) AS c FROM embeddings)
    SELECT vec_id, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS predicted,
      round(CAST(greatest(a, b, c) AS DOUBLE), 3) + 0.0e0 AS best FROM s""",
)
def score_vectors(spark, sf_dir):
    """Three classes scored by the sums of three slices of the vector."""

    def make_scorer():
        def predict(batch):
            wide = batch.astype("float64")
            slices = [wide[:, 0:20], wide[:, 20:40], wide[:, 40:60]]
            return np.stack([x.sum(axis=1) for x in slices], axis=1).astype("float32")

        return predict

    scored = training.score_vectors(load(spark, sf_dir, "embeddings"), "embedding", make_scorer)
    out = scored.select(
        "vec_id", "predicted", F.array_max("probs").cast("double").alias("best")
    )
    return rounded(out, ["best"], 3)


# Learners on one binary feature have a closed form: what they must predict is a group mean.

_ONE_FEATURE_SQL = """r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS x, o_totalprice AS y,
    CASE WHEN (o_orderstatus <> 'F' AND o_custkey % 4 = 0) OR (o_orderstatus = 'F' AND o_custkey % 3 <> 0) THEN 1 ELSE 0 END AS c
    FROM orders),
  g AS (SELECT x, count(*) AS n, avg(y) AS mean, avg(CAST(c AS DOUBLE)) AS share FROM r GROUP BY x)"""


def _one_feature(spark, sf_dir, label):
    """(o_orderkey, x, label, features): a binary feature, and next to it one that says nothing."""
    orders = load(spark, sf_dir, "orders")
    fixed = F.col("o_orderstatus") == "F"
    y = F.col("o_totalprice")
    buyer = F.col("o_custkey")
    c = F.when((~fixed & (buyer % 4 == 0)) | (fixed & (buyer % 3 != 0)), 1.0).otherwise(0.0)
    rows = orders.select(
        "o_orderkey", F.when(fixed, 1.0).otherwise(0.0).alias("x"), F.lit(7.0).alias("same"),
        (y if label == "y" else c).alias("label"),
    )
    return training.assemble(["x", "same"]).transform(rows)


def _per_value(predictions, value, name="prediction"):
    out = predictions.groupBy(F.col("x").cast("int").alias("x")).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias(name))
    return rounded(out, [name], 3)


@query(
    "forest_regressor_one_feature",
    f"WITH {_ONE_FEATURE_SQL} SELECT CAST(x AS INTEGER) AS x, n, round(mean, 3) + 0.0e0 AS prediction FROM g",
)
def forest_regressor_one_feature(spark, sf_dir):
    """A forest of one unsampled tree predicts the mean of each leaf."""
    rows = _one_feature(spark, sf_dir, "y")
    model = training.forest_regressor(trees=1, depth=3).setBootstrap(False).fit(rows)
    return _per_value(model.transform(rows), "prediction")


@query(
    "boosted_regressor_one_feature",
    f"WITH {_ONE_FEATURE_SQL} SELECT CAST(x AS INTEGER) AS x, n, round(mean, 3) + 0.0e0 AS prediction FROM g",
)
def boosted_regressor_one_feature(spark, sf_dir):
    """The first round of boosting is a tree; later rounds find nothing left to fit."""
    rows = _one_feature(spark, sf_dir, "y")
    model = training.boosted_regressor(iterations=3, depth=2).fit(rows)
    return _per_value(model.transform(rows), "prediction")


@query(
    "logistic_one_feature",
    f"WITH {_ONE_FEATURE_SQL} SELECT CAST(x AS INTEGER) AS x, n, round(share, 3) + 0.0e0 AS probability FROM g",
)
def logistic_one_feature(spark, sf_dir):
    """Without a penalty the fitted probability is the share of each group."""
    rows = _one_feature(spark, sf_dir, "c")
    model = training.logistic_regression(1).setRegParam(0.0).setMaxIter(200).setTol(1e-12).fit(rows)
    score = vector_to_array("probability")[1]
    return _per_value(model.transform(rows), score, "probability")


@query(
    "forest_classifier_one_feature",
    f"WITH {_ONE_FEATURE_SQL} SELECT CAST(x AS INTEGER) AS x, n, round(share, 3) + 0.0e0 AS probability FROM g",
)
def forest_classifier_one_feature(spark, sf_dir):
    rows = _one_feature(spark, sf_dir, "c")
    model = training.forest_classifier(trees=1, depth=3).setBootstrap(False).fit(rows)
    return _per_value(model.transform(rows), vector_to_array("probability")[1], "probability")


@query(
    "boosted_classifier_one_feature",
    f"""WITH {_ONE_FEATURE_SQL}
    SELECT CAST(x AS INTEGER) AS x, n, CASE WHEN share > 0.5 THEN 1.0e0 ELSE 0.0e0 END AS prediction FROM g""",
)
def boosted_classifier_one_feature(spark, sf_dir):
    """Boosting on one feature says the larger class of each group."""
    rows = _one_feature(spark, sf_dir, "c")
    model = training.boosted_classifier(iterations=3, depth=2).fit(rows)
    return _per_value(model.transform(rows), "prediction")


@query(
    "importance_one_feature",
    """SELECT 'x' AS feature, CASE WHEN count(DISTINCT o_orderstatus = 'F') = 2 THEN 1.0e0 ELSE 0.0e0 END AS importance FROM orders
    UNION ALL SELECT 'same', 0.0e0 FROM (SELECT count(*) FROM orders)""",
)
def importance_one_feature(spark, sf_dir):
    """All importance goes to the only feature that says something."""
    rows = _one_feature(spark, sf_dir, "y")
    model = training.forest_regressor(trees=5, depth=2).fit(rows)
    return training.feature_importance(spark, model, ["x", "same"])


@query(
    "cv_depth_grid",
    f"""WITH r AS (SELECT o_totalprice AS y, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS x,
      {_part_sql(1, 'o_orderkey', 3)} AS fold FROM orders),
    k AS (SELECT f FROM range(3) k(f)),
    flat AS (SELECT f, avg(y) AS m FROM r, k WHERE fold <> f GROUP BY f),
    leaf AS (SELECT f, x, avg(y) AS m FROM r, k WHERE fold <> f GROUP BY f, x),
    e AS (SELECT 0.0e0 AS "maxDepth", f, sqrt(avg((y - m) * (y - m))) AS e FROM r JOIN flat ON fold = f GROUP BY f
      UNION ALL SELECT 1.0e0, leaf.f, sqrt(avg((y - m) * (y - m))) FROM r JOIN leaf ON fold = leaf.f AND r.x = leaf.x GROUP BY leaf.f),
    m AS (SELECT "maxDepth", avg(e) AS metric FROM e GROUP BY "maxDepth")
    SELECT "maxDepth", round(metric, 2) + 0.0e0 AS metric, metric = (SELECT min(metric) FROM m) AS best FROM m""",
)
def cv_depth_grid(spark, sf_dir):
    """Three-fold grid search over depth: no split is the mean, one split is the mean of each group."""
    rows = training.with_fold(_one_feature(spark, sf_dir, "y"), "o_orderkey", 3)
    tree = training.forest_regressor(trees=1).setBootstrap(False)
    table, _ = training.cross_validate(rows, tree, {"maxDepth": [0, 1]}, folds=3)
    return rounded(table, ["metric"], 2)


_FOLD_ROWS_SQL = f"""r AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS x, o_totalprice AS y,
      CASE WHEN (o_orderstatus <> 'F' AND o_custkey % 4 = 0) OR (o_orderstatus = 'F' AND o_custkey % 3 <> 0) THEN 1 ELSE 0 END AS c,
      {_part_sql(1, 'o_orderkey', 3)} AS fold FROM orders),
    k AS (SELECT f FROM range(3) k(f)),
    leaf AS (SELECT f, x, avg(y) AS m, avg(CAST(c AS DOUBLE)) AS share FROM r, k WHERE fold <> f GROUP BY f, x),
    flat AS (SELECT f, avg(y) AS m, avg(CAST(c AS DOUBLE)) AS share FROM r, k WHERE fold <> f GROUP BY f)"""
#: Trees by depths: without sampling every tree of a depth is the same.
_SMALL_GRID = {"numTrees": [1, 2, 5], "maxDepth": [0, 1, 4]}
_SMALL_GRID_SQL = """t AS (SELECT unnest([1.0e0, 2.0e0, 5.0e0]) AS "numTrees"), d AS (SELECT unnest([0, 1, 4]) AS d)"""


@query(
    "cv_logistic_one_feature",
    f"""WITH {_FOLD_ROWS_SQL},
    a AS (SELECT leaf.f, avg(CASE WHEN (share > 0.5) = (c = 1) THEN 1.0e0 ELSE 0.0e0 END) AS right_
      FROM r JOIN leaf ON fold = leaf.f AND r.x = leaf.x GROUP BY leaf.f)
    SELECT 0.0e0 AS "regParam", round(avg(right_), 6) + 0.0e0 AS metric, true AS best FROM a""",
)
def cv_logistic_one_feature(spark, sf_dir):
    """Three-fold accuracy of a logistic model on one binary feature: each group says its usual label."""
    rows = training.with_fold(_one_feature(spark, sf_dir, "c"), "o_orderkey", 3)
    model = training.logistic_regression(1).setMaxIter(200).setTol(1e-12)
    table, _ = training.cross_validate(rows, model, {"regParam": [0.0]}, task="classification", folds=3)
    return rounded(table, ["metric"], 6)


@query(
    "forest_grid_regression",
    f"""WITH {_FOLD_ROWS_SQL}, {_SMALL_GRID_SQL},
    e AS (SELECT d, flat.f, sqrt(avg((y - flat.m) * (y - flat.m))) AS e FROM r JOIN flat ON fold = flat.f, d WHERE d = 0 GROUP BY d, flat.f
      UNION ALL SELECT d, leaf.f, sqrt(avg((y - leaf.m) * (y - leaf.m))) FROM r JOIN leaf ON fold = leaf.f AND r.x = leaf.x, d WHERE d > 0 GROUP BY d, leaf.f),
    m AS (SELECT "numTrees", d, avg(e) AS metric FROM e, t GROUP BY "numTrees", d)
    SELECT "numTrees", CAST(d AS DOUBLE) AS "maxDepth", round(metric, 2) + 0.0e0 AS metric FROM m""",
)
def forest_grid_regression(spark, sf_dir):
    """A whole grid from one forest per fold: no split is the mean, any deeper tree the mean of each group."""
    rows = training.with_fold(_one_feature(spark, sf_dir, "y"), "o_orderkey", 3)
    forest = training.forest_regressor().setBootstrap(False).setFeatureSubsetStrategy("all")
    table, _ = training.search_forest(rows, forest, _SMALL_GRID, folds=3, refit=False)
    return rounded(table.drop("best"), ["metric"], 2)


@query(
    "forest_grid_classification",
    f"""WITH {_FOLD_ROWS_SQL}, {_SMALL_GRID_SQL},
    e AS (SELECT d, flat.f, avg(CASE WHEN (flat.share > 0.5) = (c = 1) THEN 1.0e0 ELSE 0.0e0 END) AS e FROM r JOIN flat ON fold = flat.f, d WHERE d = 0 GROUP BY d, flat.f
      UNION ALL SELECT d, leaf.f, avg(CASE WHEN (leaf.share > 0.5) = (c = 1) THEN 1.0e0 ELSE 0.0e0 END) FROM r JOIN leaf ON fold = leaf.f AND r.x = leaf.x, d WHERE d > 0 GROUP BY d, leaf.f),
    m AS (SELECT "numTrees", d, avg(e) AS metric FROM e, t GROUP BY "numTrees", d)
    SELECT "numTrees", CAST(d AS DOUBLE) AS "maxDepth", round(metric, 6) + 0.0e0 AS metric FROM m""",
)
def forest_grid_classification(spark, sf_dir):
    """The same for a classifier: the usual label, or that of each group."""
    rows = training.with_fold(_one_feature(spark, sf_dir, "c"), "o_orderkey", 3)
    forest = training.forest_classifier().setBootstrap(False).setFeatureSubsetStrategy("all")
    table, _ = training.search_forest(rows, forest, _SMALL_GRID, task="classification", folds=3, refit=False)
    return rounded(table.drop("best"), ["metric"], 6)
