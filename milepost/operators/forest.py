"""Scores of every smaller forest from one grown forest.

The first k trees of a forest are a forest of k trees, and a tree cut at some depth is the tree that a smaller depth limit
leaves: splits are chosen from the root down, each without regard to what comes below it. So one forest, as large and as
deep as any wanted, is applied once, and every (number of trees, depth) is scored from the leaves its rows fall into.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.scratch import new_path

#: Rows scored at a time inside a task.
ROWS = 2048


def forest_votes(
    spark: SparkSession, model, depths: Sequence[int], classes: bool
) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """What each leaf of a fitted forest says when its tree is cut at some depth, and where the leaves of each tree start.

    By depth, (leaves of all trees, classes) shares for a classifier and (leaves, 1) means for a regressor, leaves in their
    order from left to right. Read from the form a model is saved in; as large as the model, which the driver holds
    anyway. Two sister leaves that say the same are one leaf, as the learner prunes them too.
    """
    path = new_path(spark, "forest")
    model.write().overwrite().save(path)
    columns = ["treeID", *[f"nodeData.{c}" for c in ("id", "prediction", "impurityStats", "leftChild", "rightChild")]]
    nodes = spark.read.parquet(f"{path}/data").select(*columns).orderBy("treeID", "id").toPandas()
    parts: dict[int, list[np.ndarray]] = {d: [] for d in depths}
    first = [0]
    for _, tree in nodes.groupby("treeID"):
        left, right = tree["leftChild"].to_numpy(), tree["rightChild"].to_numpy()
        says = tree["prediction"].to_numpy()
        stats = np.stack(tree["impurityStats"].to_numpy())
        vote = stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300) if classes else says[:, None]
        inner = np.flatnonzero(left >= 0)  # a parent stands before its children
        level = np.zeros(len(tree), int)
        for v in inner:
            level[left[v]] = level[right[v]] = level[v] + 1
        for d in depths:
            ends = (left < 0) | (level >= d)
            for v in inner[::-1]:
                a, b = left[v], right[v]
                ends[v] |= ends[a] and ends[b] and says[a] == says[b]
            stop = np.arange(len(tree))
            for v in inner:
                if ends[stop[v]]:
                    stop[left[v]] = stop[right[v]] = stop[v]
            parts[d].append(vote[stop[left < 0]])
        first.append(first[-1] + int((left < 0).sum()))
    return {d: np.concatenate(p) for d, p in parts.items()}, np.array(first[:-1])


def prefix_scores(
    rows: DataFrame, model, trees: Sequence[int], depths: Sequence[int], classes: bool, label: str = "label"
) -> DataFrame:
    """(trees, depth, n, miss) of every smaller forest over ``rows``: wrongly named rows, or the sum of squared errors.

    ``rows`` has ``features``. Each task applies the model once and adds up its rows, so trees x depths numbers leave it.
    Rows without a label are left out.
    """
    trees, depths = sorted(set(trees)), sorted(set(depths))
    votes = forest_votes(rows.sparkSession, model, depths, classes)
    if trees[0] < 1 or trees[-1] > len(votes[1]):
        raise ValueError(f"a forest of {len(votes[1])} trees has no prefix of {trees[0]} to {trees[-1]}")
    shared = rows.sparkSession.sparkContext.broadcast(votes)
    ends, at_once = np.array(trees) - 1, ROWS

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        by_depth, start = shared.value
        n, miss = 0, np.zeros((len(depths), len(trees)))
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                truth = part.column(0).to_numpy(zero_copy_only=False)
                leaf = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("int64").reshape(len(truth), -1)
                n += len(truth)
                for i, d in enumerate(depths):
                    said = np.cumsum(by_depth[d][start + leaf], axis=1)[:, ends]
                    if classes:
                        miss[i] += (said.argmax(axis=2) != truth[:, None]).sum(axis=0)
                    else:
                        off = said[:, :, 0] / (ends + 1) - truth[:, None]
                        miss[i] += (off * off).sum(axis=0)
        table = [(k, d, n, float(miss[i, j])) for i, d in enumerate(depths) for j, k in enumerate(trees)]
        kinds = pa.int32(), pa.int32(), pa.int64(), pa.float64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table), kinds)], names=["trees", "depth", "n", "miss"])

    leaves = model.copy().setLeafCol("__leaf").transform(rows.where(F.col(label).isNotNull()))
    fallen = leaves.select(F.col(label).cast("double"), vector_to_array("__leaf"))
    return fallen.mapInArrow(run, "trees int, depth int, n bigint, miss double").groupBy("trees", "depth").agg(
        F.sum("n").alias("n"), F.sum("miss").alias("miss")
    )
