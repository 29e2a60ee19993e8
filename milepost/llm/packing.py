"""Best-fit packing planned on the length histogram.

The histogram has at most ``capacity`` rows, whatever the corpus. Best-fit decreasing runs on its
counts: many documents of one length go to many equal sequences in one step. The plan is a short list
of runs; Spark expands the runs to slots (length, rank within length) -> (sequence, offset), and
documents take their slot by an equi-join on (length, rank), a unique key, so no key is hot.

Ranks need no sort and no window over documents: every task counts up per length while it cuts texts,
and the counts per (task, length) give each task its first rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from milepost.llm.encode import cut, default_tokenizer, encoder
from milepost.operators.scratch import written

#: Slots that one row of the expanded plan makes at most; longer runs are cut first.
RUN_ROWS = 50_000
END_ID = 1


class Run(NamedTuple):
    """Documents of one length with ranks from ``first_rank``: ``per_sequence`` in each sequence from ``first_sequence``."""

    length: int
    first_rank: int
    documents: int
    first_sequence: int
    per_sequence: int
    offset: int


def plan_runs(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over counts: the sequences that one document at a time would get."""
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs: list[Run] = []
    sequences = 0

    def put_back(room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if room not in open_by_room:
            open_by_room[room] = []
            bisect.insort(rooms, room)
        open_by_room[room].append((first, count))

    def take(length: int, rank: int, left: int, room: int, first: int, count: int) -> int:
        """Fill equal sequences with room ``room``; the number of documents placed."""
        each = room // length
        placed = min(left, each * count)
        runs.append(Run(length, rank, placed, first, each, capacity - room))
        full, rest = divmod(placed, each)
        put_back(room - each * length, first, full)
        if rest:
            put_back(room - rest * length, first + full, 1)
        put_back(room, first + full + bool(rest), count - full - bool(rest))
        return placed

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        left, rank = histogram[length], 0
        while left and (at := bisect.bisect_left(rooms, length)) < len(rooms):
            room = rooms[at]
            first, count = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room], rooms[at]
            placed = take(length, rank, left, room, first, count)
            left, rank = left - placed, rank + placed
        if left:
            count = -(-left // (capacity // length))
            take(length, rank, left, capacity, sequences, count)
            sequences += count
    return runs


def cut_documents(
    docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of every document: ids of the whole text, then the end id, cut only where longer than ``capacity``.

    Null texts are empty (one piece with the end id). Repeated rows and null ids each keep their pieces.
    ``task`` and ``rank`` count pieces of one length within one task; write the rows before using them.
    """
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, task = encoder(path), TaskContext.get().partitionId()
        end, ranks = END_ID.to_bytes(4, "little"), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for row, text in enumerate(batch.column(1)):
                for piece, (start, ids) in enumerate(cut(encode(text.as_py() or "") + end, capacity)):
                    length = len(ids) // 4
                    rows.append((row, piece, start, length, zlib.crc32(ids), ranks[length]))
                    ranks[length] += 1
            row, piece, start, length, crc, rank = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        pieces, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"
    )


def ranked(pieces: DataFrame) -> DataFrame:
    """``rank`` within length over all tasks, gapless from 0, instead of within (task, length)."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    return pieces.join(firsts, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("first_rank")).drop("first_rank", "task")


def slots(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """One row per planned place: (length, rank) -> (sequence_id, offset)."""
    names = "length bigint, first_rank bigint, documents bigint, first_sequence bigint, per_sequence bigint, first_offset bigint"
    cuts = F.explode(F.sequence(F.lit(0), F.col("documents") - 1, F.lit(RUN_ROWS).cast("bigint")))
    last = F.least(F.col("cut") + RUN_ROWS, F.col("documents")) - 1
    plan = spark.createDataFrame([tuple(r) for r in runs], names).withColumn("cut", cuts).repartition("length", "cut")
    placed = plan.withColumn("i", F.explode(F.sequence("cut", last)))
    return placed.select(
        "length",
        (F.col("first_rank") + F.col("i")).alias("rank"),
        (F.col("first_sequence") + F.expr("i div per_sequence")).alias("sequence_id"),
        (F.col("first_offset") + F.col("i") % F.col("per_sequence") * F.col("length")).alias("offset"),
    )


def pack(
    docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every piece with its sequence and offset; see ``cut_documents`` for nulls and repeated rows.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Of equal lengths any document may
    take any slot. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    pieces = written(cut_documents(docs, capacity, tokenizer, id_col, text_col), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    planned = slots(docs.sparkSession, plan_runs(histogram, capacity))
    return ranked(pieces).join(planned, ["length", "rank"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
