"""Packed token-id matrices: best-fit decreasing within bounded windows, written as binary rows.

Each task packs its own documents, so nothing is shuffled: it gathers pieces up to ``window_tokens``,
packs them longest first into rows of ``capacity`` ids, and goes on with the next window. Memory is
bounded by the window and by one document, and a retried task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.encode import cut, default_tokenizer, encoder
from milepost.llm.packing import END_ID

SCHEMA = (
    "task int, window int, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, pieces array<int>, starts array<bigint>"
)


class CapacityTree:
    """Segment tree over free capacities: how many open rows have room in each range of room sizes."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def least_room(self, need: int) -> int:
        """Smallest room of at least ``need``; -1 if no open row has it."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the indexes of the pieces in each row; equal lengths in their order."""
    tree, rows, by_room = CapacityTree(capacity), [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.least_room(lengths[i])
        if room < 0:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        if room := room - lengths[i]:
            by_room.setdefault(room, []).append(row)
            tree.add(room, 1)
    return rows


def pack_matrices(
    docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, window_tokens: int = 2_000_000, pad_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows of ``capacity`` ids (little-endian unsigned 32-bit, padded with ``pad_id``) and what lies in them.

    ``cu_seqlens`` has the cumulative lengths from 0, ``position_resets`` the places where position ids start
    again at 0. Documents are their ids and the end id; longer ones are cut losslessly: (doc_ids, pieces, starts)
    name each piece. Null texts are empty documents; null ids and repeated rows keep their place; other columns
    are not read; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()

    def matrices(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, task = encoder(path), TaskContext.get().partitionId()
        end, pad = END_ID.to_bytes(4, "little"), pad_id.to_bytes(4, "little")
        held: list[tuple] = []
        tokens = window = 0

        def out():
            table = []
            for k, row in enumerate(fit([len(p[3]) // 4 for p in held], capacity)):
                bounds = [0]
                for i in row:
                    bounds.append(bounds[-1] + len(held[i][3]) // 4)
                ids = b"".join(held[i][3] for i in row) + pad * (capacity - bounds[-1])
                table.append(
                    (task, window, k, bounds[-1], ids, bounds, bounds[:-1], *([held[i][c] for i in row] for c in range(3)))
                )
            kinds = [
                pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()),
            ]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table), kinds)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                for piece, (start, ids) in enumerate(cut(encode(text.as_py() or "") + end, capacity)):
                    held.append((doc.as_py(), piece, start, ids))
                    tokens += len(ids) // 4
                if tokens >= window_tokens:
                    yield out()
                    held, tokens, window = [], 0, window + 1
        if held:
            yield out()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(matrices, SCHEMA)


def unpack(matrix: DataFrame) -> DataFrame:
    """(doc_id, piece, start, ids array) back from packed rows, for consumers and for checking the round trip."""
    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                ids, ends = np.frombuffer(r["ids"], "<u4").astype("int64"), r["cu_seqlens"]
                cells = [pa.array(r["doc_ids"], pa.int64()), pa.array(r["pieces"], pa.int32()), pa.array(r["starts"], pa.int64())]
                parts = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*cells, pa.array(parts, pa.list_(pa.int64()))], names=["doc_id", "piece", "start", "ids"])

    columns = matrix.select("ids", "cu_seqlens", "doc_ids", "pieces", "starts")
    return columns.mapInArrow(read, "doc_id bigint, piece int, start bigint, ids array<bigint>")
