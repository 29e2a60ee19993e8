"""The best few of many scores: kept per slot inside a task, merged between tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stands for a missing id: the last of equal scores.
NO_ID = np.iinfo("int64").max
_LEAST = np.iinfo("int64").min
#: Parts that the rows of one slot are merged in before they meet.
_SALTS = 64


class Best:
    """The ``k`` best (score, id) of each slot: higher scores first, equal ones by smaller id.

    What two of them hold can be merged by offering the one's rows to the other. Memory follows slots times ``k``.
    """

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), _LEAST, "int64")
        self.id = np.full((slots, k), NO_ID, "int64")
        self.held = np.zeros(slots, "int64")

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """A tile of scores, one row for each of ``slots`` (all different) and one column for each of ``ids``."""
        low, last = self.score[slots, -1:], self.id[slots, -1:]
        good = allowed & ((scores > low) | ((scores == low) & ((ids < last) | (self.held[slots, None] < self.k))))
        width = scores.shape[1]
        if width > self.k and np.count_nonzero(good) > 4 * self.k * len(slots):
            # Far more than can stay: in each row nothing under its own k-th best is wanted, ties with it are.
            kth = np.partition(np.where(good, scores, _LEAST), width - self.k, axis=1)[:, width - self.k, None]
            good &= scores >= kth
        row, column = np.nonzero(good)
        self.add(slots[row], scores[row, column], ids[column])

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Single rows, any number for one slot."""
        if not len(slot):
            return
        touched = np.unique(slot)
        there = np.arange(self.k) < self.held[touched, None]
        slot = np.concatenate([np.repeat(touched, self.held[touched]), slot])
        score = np.concatenate([self.score[touched][there], score])
        ids = np.concatenate([self.id[touched][there], ids])
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(slot)]]))
        rank = np.arange(len(slot)) - np.repeat(first, sizes)
        stay = rank < self.k
        self.score[slot[stay], rank[stay]] = score[stay]
        self.id[slot[stay], rank[stay]] = ids[stay]
        self.held[touched] = np.minimum(sizes, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all that is held."""
        slot, rank = np.nonzero(np.arange(self.k) < self.held[:, None])
        return slot, self.score[slot, rank], self.id[slot, rank]


def named(ids: Column) -> Column:
    """Ids as they are compared: a missing one comes last."""
    return F.coalesce(ids.cast("bigint"), F.lit(int(NO_ID)).cast("bigint"))


def unnamed(ids: Column) -> Column:
    return F.nullif(ids, F.lit(int(NO_ID)).cast("bigint"))


def best_rows(rows: DataFrame, keys: list[str], score: str, ids: str, k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` best rows of every key with their rank from 1.

    The rows of a key, ``k`` of each task at most, are first merged in parts, so that what meets in one task does not
    follow the number of tasks.
    """
    order = [F.desc(score), F.asc(ids)]
    part = rows.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    few = part.withColumn(rank, F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))).where(F.col(rank) <= k)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return few.drop("_part").withColumn(rank, last).where(F.col(rank) <= k)
