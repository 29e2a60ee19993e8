"""Encoding, splitting, training, comparing and applying models with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.util import inheritable_thread_target

from milepost.functions.scalars import arg_max
from milepost.functions.statistics import number_from_md5
from milepost.operators.evaluation import accuracy, rmse, roc_auc
from milepost.operators.forest import prefix_scores
from milepost.operators.profile import union_all
from milepost.operators.scratch import written


# The grids searched for the two forests.
PRICE_FOREST_GRID = {"numTrees": list(range(35, 50, 5)), "maxDepth": list(range(5, 10))}
CHURN_FOREST_GRID = {"numTrees": list(range(1, 100, 5)), "maxDepth": list(range(1, 20, 5))}


#: Different values of a column that an encoder may hold on the driver.
MOST_LABELS = 100_000

#: Training rows up to this number stay in the tasks they came in; a task is dealt so many more at most.
FEW_ROWS, TASK_ROWS = 50_000, 500_000


def price_models() -> dict[str, Estimator]:
    """The three regressors compared on prices."""
    return {
        "linear": linear_regression(),
        "forest": forest_regressor(),
        "boosted": boosted_regressor(),
    }


def churn_models(rows: int) -> dict[str, Estimator]:
    """The three classifiers compared on churn."""
    return {
        "logistic": logistic_regression(rows),
        "forest": forest_classifier(),
        "boosted": boosted_classifier(),
    }


def ordinal_encoder(columns: Sequence[str], suffix: str = "_code") -> StringIndexer:
    """Code = rank of the value in sorted order; unseen values and nulls get the next code."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def check_labels(df: DataFrame, columns: Sequence[str], most: int = MOST_LABELS) -> None:
    """Raise where a column has more than about ``most`` different values: its encoder would hold them all on the driver."""
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    if wide := [f"{c} ({row[c]})" for c in columns if row[c] > most]:
        raise ValueError(f"more than {most} different values to encode in {', '.join(wide)}")


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per column, taken from the training rows."""

    moments: Mapping[str, tuple[float | None, float | None]]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> Scaling:
        row = df.agg(*[
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
        ]).first()
        return Scaling({c: (row[c]["mean"], row[c]["std"]) for c in columns})

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - mean) / deviation; a constant column becomes zero."""
        scaled = {
            c + suffix: (F.col(c) - F.lit(mean)) / F.lit(std or 1.0)
            for c, (mean, std) in self.moments.items()
        }
        return df.withColumns(scaled)


def hash_part(key: Column, seed: int, parts: int) -> Column:
    """Part number of a row from its key: the same on every run and in any task."""
    return (number_from_md5(F.lit(seed), key) % parts).cast("int")


def split(df: DataFrame, key: str, seed: int = 0, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by key hash."""
    part = hash_part(F.col(key), seed, 100)
    return df.where(part >= test_percent), df.where(part < test_percent)


def with_fold(df: DataFrame, key: str, folds: int, seed: int = 1) -> DataFrame:
    return df.withColumn("fold", hash_part(F.col(key), seed, folds))


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def linear_regression() -> LinearRegression:
    return LinearRegression(labelCol="label", featuresCol="features", regParam=0.0)


def forest_regressor(trees: int = 45, depth: int = 9, seed: int = 12345) -> RandomForestRegressor:
    # A row keeps its node of each tree, in place of going down from the root once for every level.
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)


def boosted_regressor(iterations: int = 100, depth: int = 5, seed: int = 12345) -> GBTRegressor:
    return GBTRegressor(maxIter=iterations, maxDepth=depth, seed=seed)


def logistic_regression(rows: int) -> LogisticRegression:
    """L2 penalty of strength one in total, that is ``1 / rows`` per row."""
    return LogisticRegression(elasticNetParam=0.0, regParam=1.0 / max(rows, 1), standardization=False)


def forest_classifier(trees: int = 66, depth: int = 16, seed: int = 12345) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)


def boosted_classifier(iterations: int = 150, depth: int = 5, seed: int = 12345) -> GBTClassifier:
    return GBTClassifier(maxIter=iterations, maxDepth=depth, seed=seed)


@dataclass
class Spec:
    """What to train on: label, features and models by name."""

    key: str
    label: str
    numeric: Sequence[str]
    categories: Sequence[str] = ()
    task: str = "regression"
    scale: Sequence[str] = ()
    models: Mapping[str, Estimator] = field(default_factory=dict)
    seed: int = 0
    test_percent: int = 20
    most_labels: int = MOST_LABELS


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    encoder: PipelineModel | None
    scaling: Scaling
    features: list[str]


def model_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """Key, label and features of every row, written to the shared folder: training and judging read them many times."""
    columns = [spec.key, spec.label, *spec.numeric, *spec.categories]
    return written(df.select(*columns).withColumn("label", F.col(spec.label).cast("double")), "model-rows")


def prepare(df: DataFrame, spec: Spec) -> Prepared:
    """Split first, then fit encoder and scaling on the training rows only."""
    return prepare_rows(model_rows(df, spec), spec)


def prepare_rows(rows: DataFrame, spec: Spec) -> Prepared:
    """``prepare`` for rows of ``model_rows``, which are not written again."""
    train, test = split(rows, spec.key, spec.seed, spec.test_percent)
    encoder = None
    if spec.categories:
        check_labels(train, spec.categories, spec.most_labels)
        encoder = Pipeline(stages=[ordinal_encoder(spec.categories)]).fit(train)
        train, test = encoder.transform(train), encoder.transform(test)
    scaling = Scaling.fit(train, spec.scale) if spec.scale else Scaling({})
    features = [*spec.numeric, *[c + "_code" for c in spec.categories]]
    ready = assemble(features)
    keep = [spec.key, "label", "features"]
    return Prepared(
        ready.transform(scaling.apply(train)).select(*keep),
        ready.transform(scaling.apply(test)).select(*keep),
        encoder,
        scaling,
        features,
    )


def dealt(train: DataFrame) -> DataFrame:
    """The rows in equal parts, one for every task that runs at a time, or several of ``TASK_ROWS`` at most.

    Learners run hundreds of short steps, each as long as its largest part. Up to ``FEW_ROWS`` nothing moves.
    """
    n = train.count()
    if n <= FEW_ROWS:
        return train
    places = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(places * -(-n // (places * TASK_ROWS)))


def together(spark: SparkSession, run: Callable, items: Sequence, at_once: int | None = None) -> list:
    """Results of ``run`` for each item, all (or ``at_once``) at a time: one learner's steps leave tasks' places and pauses to the others."""
    if not items:
        return []
    with ThreadPool(min(len(items), at_once or len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)


def evaluate(predictions: DataFrame, task: str, model: str) -> DataFrame:
    """One row of hold-out measures with the model's name; the model is applied once, its predictions are written."""
    if task == "regression":
        scored = written(predictions.select("label", "prediction"), "scored")
        return rmse(scored, "label", "prediction").select(
            F.lit(model).alias("model"), "rmse", "mean_prediction"
        )
    scored = written(
        predictions.select("label", "prediction", vector_to_array("probability")[1].alias("score")), "scored"
    )
    right = accuracy(scored, "label", "prediction").select("accuracy").scalar()
    area = roc_auc(scored, "score", "label").select("auc").scalar()
    one_row = predictions.sparkSession.range(1)
    return one_row.select(F.lit(model).alias("model"), right.alias("accuracy"), area.alias("roc_auc"))


def train_compare(df: DataFrame, spec: Spec) -> tuple[DataFrame, dict[str, object]]:
    """Train every model on the same split; returns the comparison table and the fitted models."""
    return compare_rows(model_rows(df, spec), spec)


def compare_rows(rows: DataFrame, spec: Spec) -> tuple[DataFrame, dict[str, object]]:
    """``train_compare`` for rows of ``model_rows``; a model is judged while others are still fitted."""
    data = prepare_rows(rows, spec)
    train = dealt(data.train).persist()

    def fit_and_judge(name: str) -> tuple[object, DataFrame]:
        model = spec.models[name].fit(train)
        return model, evaluate(model.transform(data.test), spec.task, name)

    try:
        train.count()
        found = together(rows.sparkSession, fit_and_judge, list(spec.models))
    finally:
        train.unpersist()
    return union_all([judged for _, judged in found]), {name: model for name, (model, _) in zip(spec.models, found)}


def against_baseline(df: DataFrame, spec: Spec, table: DataFrame) -> DataFrame:
    """``table`` of ``train_compare`` with ``n_test``, ``baseline`` and ``better``.

    The baseline says the same for every test row: the training rows' mean label (its RMSE), or their most frequent label,
    the lower of equal ones (its accuracy, which a classifier must reach). Both are taken from the same split by key.
    """
    rows = df.select(spec.key, F.col(spec.label).cast("double").alias("label"))
    train, test = split(rows, spec.key, spec.seed, spec.test_percent)
    n = F.count(F.lit(1)).alias("n_test")
    if spec.task == "regression":
        usual = train.agg(F.avg("label")).scalar()
        miss = F.col("label") - usual
        one = test.agg(n, F.sqrt(F.avg(miss * miss)).alias("baseline"))
        better = F.col("rmse") < F.col("baseline")
    else:
        counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        usual = counts.agg(F.max(F.struct("n", -F.col("label")))).scalar()
        one = test.agg(n, F.avg((F.col("label") == -usual["col2"]).cast("double")).alias("baseline"))
        better = F.col("accuracy") >= F.col("baseline")
    both = one.select(F.struct("n_test", "baseline")).scalar()
    return table.withColumns({"n_test": both["n_test"], "baseline": both["baseline"]}).withColumn("better", better)


def cross_validate(
    train: DataFrame,
    estimator: Estimator,
    grid: Mapping[str, Sequence[object]],
    task: str = "regression",
    folds: int = 5,
    parallelism: int = 4,
) -> tuple[DataFrame, CrossValidatorModel]:
    """K-fold score of every grid point; ``train`` has label, features and a ``fold`` column.

    Returns rows (the grid parameters, metric, best) and the fitted validator, whose best model is
    the one with the lowest error or the highest accuracy. Folds are fitted at a time.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    judge = (
        RegressionEvaluator(metricName="rmse")
        if task == "regression"
        else MulticlassClassificationEvaluator(metricName="accuracy")
    )
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=points,
        evaluator=judge,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    train = dealt(train).persist()
    try:
        sizes = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}
        if wrong := [f for f in sizes if f is None or not 0 <= f < folds]:
            raise ValueError(f"folds are numbered from 0 to {folds - 1}, found {wrong}")
        if empty := [f for f in range(folds) if f not in sizes or len(sizes) < 2]:
            raise ValueError(f"no rows to train on or to judge in fold {empty}")

        def run(fold: int | None, point: dict) -> object:
            if fold is None:
                return estimator.copy(point).fit(train)
            fitted = estimator.copy(point).fit(train.where(F.col("fold") != fold))
            return judge.evaluate(fitted.transform(train.where(F.col("fold") == fold)))

        steps = [(fold, point) for fold in range(folds) for point in points]
        if len(points) == 1:  # the best without being judged: fitted beside the folds
            steps.append((None, points[0]))
        found = together(train.sparkSession, lambda step: run(*step), steps, max(parallelism, folds + 1))
        scores = [found[i : folds * len(points) : len(points)] for i in range(len(points))]
        means = [sum(s) / folds for s in scores]
        best = (max if judge.isLargerBetter() else min)(range(len(points)), key=lambda i: means[i])
        model = CrossValidatorModel(
            found[-1] if len(points) == 1 else run(None, points[best]), means,
            stdMetrics=[(sum((x - m) ** 2 for x in s) / folds) ** 0.5 for s, m in zip(scores, means)],
        )
    finally:
        train.unpersist()
    for param, value in validator.extractParamMap().items():
        if model.hasParam(param.name):
            model.set(model.getParam(param.name), value)
    rows = [
        (*[float(point[estimator.getParam(n)]) for n in grid], float(metric), i == best)
        for i, (point, metric) in enumerate(zip(points, means))
    ]
    names = ", ".join(f"{n} double" for n in grid)
    schema = f"{names}{', ' if names else ''}metric double, best boolean"
    return train.sparkSession.createDataFrame(rows, schema), model


def search_forest(
    train: DataFrame,
    forest: RandomForestClassifier | RandomForestRegressor,
    grid: Mapping[str, Sequence[int]],
    task: str = "regression",
    folds: int = 5,
    refit: bool = True,
) -> tuple[DataFrame, object]:
    """K-fold score of every (numTrees, maxDepth) of ``grid`` from one forest per fold; ``train`` as in ``cross_validate``.

    Each fold grows one forest with the largest number of trees and the largest depth; smaller ones are its first trees,
    cut at the smaller depth. Every forest takes the feature subset of the largest. Returns rows (numTrees, maxDepth,
    metric, best) and, with ``refit``, a forest of the best point grown on all rows; of equal points the first is best.
    """
    trees, depths, classes = list(grid["numTrees"]), list(grid["maxDepth"]), task != "regression"
    largest = forest.copy({forest.numTrees: max(trees), forest.maxDepth: max(depths)})
    train = train.persist()
    try:
        scores: dict[tuple[int, int], list[float]] = {(k, d): [] for k in trees for d in depths}

        def of_fold(fold: int) -> list:
            model = largest.fit(train.where(F.col("fold") != fold))
            return prefix_scores(train.where(F.col("fold") == fold), model, trees, depths, classes).collect()

        train.count()
        for found in together(train.sparkSession, of_fold, range(folds)):
            for r in found:
                if r["n"]:
                    scores[r["trees"], r["depth"]].append(1 - r["miss"] / r["n"] if classes else (r["miss"] / r["n"]) ** 0.5)
        means = {point: sum(found) / len(found) if found else None for point, found in scores.items()}
        known = [point for point in means if means[point] is not None]
        best = (max if classes else min)(known, key=means.get) if known else None
        model = None
        if refit and best:
            model = forest.copy({forest.numTrees: best[0], forest.maxDepth: best[1]}).fit(train)
    finally:
        train.unpersist()
    rows = [(float(k), float(d), metric, (k, d) == best) for (k, d), metric in means.items()]
    schema = "numTrees double, maxDepth double, metric double, best boolean"
    return train.sparkSession.createDataFrame(rows, schema), model


def feature_importance(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Rows (feature, importance), most important first; as many rows as features."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_vectors(
    df: DataFrame,
    vector: str,
    make_predict: Callable[[], Callable],
    batch_size: int = 1024,
) -> DataFrame:
    """Add ``probs`` and ``predicted`` (arg-max) by a caller's model, loaded once per Python worker.

    ``make_predict`` returns a function from a (batch, width) array to a (batch, classes) array.
    """
    predict = predict_batch_udf(
        make_predict,
        return_type=ArrayType(FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[[_width(df, vector)]],
    )
    return df.withColumn("probs", predict(F.col(vector))).withColumn(
        "predicted", arg_max(F.col("probs"))
    )


def _width(df: DataFrame, vector: str) -> int:
    row = df.select(F.size(vector).alias("n")).first()
    return int(row["n"]) if row else 1
