"""Hard negatives: exact inner products by Strassen's multiplication, the best of them in mergeable heaps.

Anchors are taken in blocks of bounded size. A block goes to every task, which multiplies it with its own rows tile by
tile and keeps, for each anchor, the best rows of the same label. Merged over the tasks these are the positives; their
scores fix a window of scores for each (anchor, positive), and a second pass keeps the best rows inside every window.
Nothing but these few rows per anchor and task is shuffled, and no pair of rows is ever a row of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.best import Best, best_rows, named, unnamed
from milepost.operators.scratch import written

#: Anchors of a block, of a tile, and rows of a tile.
BLOCK, ANCHORS, ROWS = 8192, 512, 2048
#: Sides up to this are multiplied plainly.
LEAF = 16
#: Whole components beyond this are taken as this.
_MOST = 2.0**62


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven half-size products; odd sides are padded with a line of zeros.

    Additions are exact (modulo 2^64, so a result that fits is right whatever the sums on the way).
    """
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a, b = np.pad(a, ((0, n % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = (n + 1) // 2, (k + 1) // 2, (m + 1) // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), "int64")
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:n, :m]


def whole(vectors, width: int, scale: float) -> np.ndarray:
    """Arrow lists of numbers as rows of ``floor(scale * x)``, filled with zeros or cut to ``width``."""
    ends = np.asarray(vectors.offsets)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    flat = np.clip(np.floor(scale * flat), -_MOST, _MOST).astype("int64")
    sizes, start = np.diff(ends), ends[:-1] - ends[0]
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), "int64")
    column = np.arange(width)
    there = column < sizes[:, None]
    out[there] = flat[(start[:, None] + column)[there]]
    return out


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    infinite = F.lit(float("inf"))
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce((x > -infinite) & (x < infinite), F.lit(False)))
    rows = vectors.select(
        named(F.col(id_col)).alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("vector"),
        finite.alias("finite"),
    )
    return rows.where("label is not null and vector is not null and finite").drop("finite")


def _scored(rows: DataFrame, shared, keep, scale: float) -> DataFrame:
    """(slot, score, id) of what ``keep`` holds at the end of each task.

    ``shared`` broadcasts (ids, labels, matrix) of the anchors and what else ``keep`` needs; ``keep`` makes from it the
    heaps and a function that offers them one tile.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        anchors = shared.value
        matrix = anchors["matrix"]
        heaps, offer = keep(anchors)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                columns = np.ascontiguousarray(whole(part.column(2), matrix.shape[1], scale).T)
                for first in range(0, len(matrix), ANCHORS):
                    tile = np.arange(first, min(first + ANCHORS, len(matrix)))
                    offer(tile, strassen(matrix[tile], columns), ids, labels)
        slot, score, ids = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (slot, score, ids)], names=["slot", "score", "id"])

    return rows.mapInArrow(run, "slot bigint, score bigint, id bigint")


def _positives(count: int):
    def keep(anchors):
        heaps = Best(len(anchors["id"]), count)

        def offer(tile, scores, ids, labels):
            same = (anchors["label"][tile, None] == labels) & (anchors["id"][tile, None] != ids)
            heaps.offer(tile, scores, ids, same)

        return heaps, offer

    return keep


def _windows(count: int, low: int, high: int):
    def keep(anchors):
        # (anchor, positive) pairs in the order of their anchors; scores as Python integers, so that nothing wraps
        of, scores = anchors["of"], [int(s) for s in anchors["positive_score"]]
        least = np.array([-(-low * s // 100) for s in scores], "int64")
        most = np.array([high * s // 100 for s in scores], "int64")
        heaps = Best(len(of), count)

        def offer(tile, scores, ids, labels):
            others = anchors["label"][tile, None] != labels
            pairs = np.arange(np.searchsorted(of, tile[0]), np.searchsorted(of, tile[-1], "right"))
            for at in range(0, len(pairs), ANCHORS):
                slots = pairs[at : at + ANCHORS]
                row = of[slots] - tile[0]
                near = scores[row]
                heaps.offer(slots, near, ids, others[row] & (near >= least[slots, None]) & (near <= most[slots, None]))

        return heaps, offer

    return keep


def mine(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``is_anchor`` is a condition over the columns of ``vectors``. A row's score is its inner product with the anchor, over
    ``floor(scale * x)`` of the components. Positives are the best ``positives`` other rows of the anchor's label,
    negatives the best ``negatives`` rows of another label whose score is between ``low`` and ``high`` percent of the
    positive's; higher scores come first, equal ones by smaller id.

    Rows with a null label, a null vector or a null, infinite or NaN component take no part. A missing id counts as the
    largest one. Rows with an anchor's id are the anchor itself, never its positive; an anchor id that stands in several
    rows takes the smallest (label, vector) of them; other repeated rows each keep their place. The shorter one of two
    vectors is filled with zeros, an empty one scores 0. Components stop at 2^62 and products wrap like a long. Other
    columns are not read; an empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col, label_col)
    chosen = _usable(vectors.where(is_anchor), id_col, vector_col, label_col)
    chosen = chosen.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first")).select("id", "first.*")
    chosen = written(chosen, "anchors")
    blocks = -(-chosen.count() // block)
    found = []
    for number in range(blocks):
        mine_now = chosen.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).orderBy("id").toArrow()
        size = mine_now.column("vector").combine_chunks()
        width = max((len(v) for v in size), default=0)
        anchors = {
            "id": mine_now.column("id").to_numpy(), "label": mine_now.column("label").to_numpy(),
            "matrix": whole(size, width, scale),
        }
        shared = spark.sparkContext.broadcast(anchors)
        best = best_rows(_scored(rows, shared, _positives(positives), scale), ["slot"], "score", "id", positives)
        pairs = best.orderBy("slot", "rank").toArrow()  # a few rows for each anchor of the block
        of, score, other = (pairs.column(c).to_numpy() for c in ("slot", "score", "id"))
        shared = spark.sparkContext.broadcast(anchors | {"of": of, "positive_score": score})
        best = best_rows(_scored(rows, shared, _windows(negatives, low, high), scale), ["slot"], "score", "id", negatives)
        about = spark.createDataFrame(
            list(zip(range(len(of)), anchors["id"][of].tolist(), other.tolist(), score.tolist())),
            "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        rows_now = best.join(about, "slot").select(
            unnamed(F.col("anchor_id")).alias("anchor_id"), unnamed(F.col("positive_id")).alias("positive_id"), "rank",
            unnamed(F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        )
        found.append(written(rows_now, "negatives"))
    if not found:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


#: The query's rows in SQL: every product of an anchor with every row.
ORACLE = """WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, c.v)]) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
