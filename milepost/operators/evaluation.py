"""Quality of scores and predicted classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.ordered import running_totals


def _curve(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Per distinct score, from the highest down: positives, negatives and their running totals."""
    rows = df.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).select(
        F.col(score).cast("double").alias("score"),
        F.col(truth).cast("long").alias("pos"),
        (1 - F.col(truth)).cast("long").alias("neg"),
    )
    return running_totals(rows, "score", ["pos", "neg"], descending=True)


def roc_auc(df: DataFrame, score: str, truth: str) -> DataFrame:
    """One row (positives, negatives, auc): exact area, ties count half; null for one class only."""
    curve = _curve(df, score, truth)
    # Negatives ranked below a score = all negatives - running negatives.
    return curve.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))).alias("won"),
    ).select(
        "positives",
        "negatives",
        F.try_divide(
            F.col("won"), F.col("positives").cast("double") * F.col("negatives")
        ).alias("auc"),
    )


def precision_recall_curve(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Rows (threshold, precision, recall) for every distinct score used as ``score >= threshold``."""
    curve = _curve(df, score, truth)
    positives = curve.agg(F.max("cum_pos")).scalar()  # from the written counts; the rows are not read again
    return curve.select(
        F.col("score").alias("threshold"),
        F.try_divide("cum_pos", F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide(F.col("cum_pos"), positives).alias("recall"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows (truth, predicted, n); every later measure works on this small frame."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows (class, precision, recall, f1, support); zero where a class was never predicted or true."""
    cells = confusion(df, truth, predicted)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("truth").alias("class"),
                    F.col("n").alias("true_n"),
                    F.lit(0).cast("long").alias("said_n"),
                    F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("long").alias("true_n"),
                    F.col("n").alias("said_n"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    hit, said, true = F.sum("hit"), F.sum("said_n"), F.sum("true_n")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return sides.groupBy("class").agg(
        zero(F.try_divide(hit, said)).alias("precision"),
        zero(F.try_divide(hit, true)).alias("recall"),
        zero(F.try_divide(hit * 2, said + true)).alias("f1"),
        true.alias("support"),
    )


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row (n, errors, accuracy)."""
    right: Column = F.count_if(F.col(truth) == F.col(predicted))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n"), (n - right).alias("errors"), F.try_divide(right, n).alias("accuracy")
    )


def rmse(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row (rmse, mean_prediction)."""
    miss = F.col(truth) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(predicted).alias("mean_prediction")
    )
