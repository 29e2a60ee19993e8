"""Benchmark passages in documents, found within an edit budget.

By the pigeonhole principle a passage with at most k edits keeps at least one of the item's k + 1
pieces. All pieces of a block of items are searched at once with one automaton; each hit points at a place
for the item, which Myers' bit-parallel distance then verifies.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of an item's characters that may be edited.
RATE = 0.08
#: Items with fewer characters after normalising have no budget: they are found unchanged, between words.
SHORT_CHARS = 20
#: Items and characters that one automaton holds; a larger benchmark takes more passes over the documents.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 20_000_000


def normal(text: str | None) -> str:
    """Lower-case words (runs of letters, digits and underscores) with one space between."""
    import re

    return " ".join(re.findall(r"\w+", (text or "").lower()))


def budget(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate) if len(item) >= SHORT_CHARS else 0


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): edits + 1 pieces that make up the item."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, item: str):
        self.item, self.masks = item, defaultdict(int)
        for i, c in enumerate(item):
            self.masks[c] |= 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the closest substring of ``text``; the first end of the smallest distance."""
        m = len(self.item)
        full, top, masks = (1 << m) - 1, 1 << (m - 1), self.masks
        plus, minus, score = full, 0, m
        least, end = m, 0
        for j, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            x = eq | minus
            d = ((((x & plus) + plus) ^ plus) | x) & full
            up, down = minus | (full & ~(d | plus)), plus & d
            score += bool(up & top) - bool(down & top)
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (full & ~(d | up)), up & d
            if score < least:
                least, end = score, j
        return least, end


class Search:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(item_id, Pattern(item), budget(item, rate)) for item_id, item in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, pattern, edits) in enumerate(self.items):
            for offset, piece in pieces(pattern.item, edits):
                places[piece].append((k, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, at)
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, smallest distance, places) of each item found."""
        if not self.items:
            return []
        seen: dict[int, list[int]] = defaultdict(list)
        for end, at in self.automaton.iter(text):
            for k, back in at:
                seen[k].append(end + 1 - back)
        found = []
        for k, starts in seen.items():
            item_id, pattern, edits = self.items[k]
            size = len(pattern.item)
            if size < SHORT_CHARS:  # the one piece is the item itself; texts have one space between words
                starts = [s for s in starts if text[s - 1 : s] in ("", " ") and text[s + size : s + size + 1] in ("", " ")]
            places = [d for d in (self._verify(text, pattern, edits, *run) for run in _runs(starts, edits)) if d <= edits]
            if places:
                found.append((item_id, min(places), len(places)))
        return found

    @staticmethod
    def _verify(text: str, pattern: Pattern, edits: int, first: int, last: int) -> int:
        """Distance of the item to the text about the starts from ``first`` to ``last``."""
        low, high = max(0, first - edits), last + len(pattern.item) + edits
        return 0 if text.find(pattern.item, low, high) >= 0 else pattern.best(text[low:high])[0]


def _runs(starts: list[int], edits: int) -> Iterator[tuple[int, int]]:
    """(first, last) of starts no further than ``edits`` apart: one look at the text serves them all."""
    first = last = None
    for start in sorted(set(starts)):
        if first is None:
            first = start
        elif start - last > edits:
            yield first, last
            first = start
        last = start
    if first is not None:
        yield first, last


def _blocks(benchmark: DataFrame, rate: float, block_items: int, id_col: str, text_col: str) -> Iterator[list]:
    """The items in blocks of about ``block_items`` items and ``BLOCK_CHARS`` characters by a hash of their text."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-size["chars"] // BLOCK_CHARS))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).distinct().collect()
        yield [(r.item_id, n) for r in rows if (n := normal(r.text))]


def matches(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_items: int = BLOCK_ITEMS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance, n_places: every benchmark item found in every document row.

    Texts are compared as lower-case words with single spaces. An item is found where some substring of the
    whole text is within ``rate`` of its characters in edits; ``distance`` is the smallest, ``n_places`` counts
    places apart from each other. Items under ``SHORT_CHARS`` characters are found unchanged and as whole words only. Null
    and empty texts and items, and items without a word, match nothing. A repeated row gives its matches again, a repeated item counts once, null ids stay null;
    other columns are not read; empty tables give no rows. The benchmark is searched in blocks, each a pass
    over the documents; only one block of items is on the driver at a time.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    schema = "doc_id bigint, item_id bigint, distance int, n_places int"

    def passed(items: list) -> DataFrame:
        def search(batches: Iterator) -> Iterator:
            import pyarrow as pa

            find = Search(items, rate)
            for batch in batches:
                out = [(i, *m) for i, t in enumerate(batch.column(1)) for m in find(normal(t.as_py()))]
                i, item, distance, places = zip(*out) if out else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(i, pa.int64())), pa.array(item, pa.int64()), pa.array(distance, pa.int32()), pa.array(places, pa.int32())],
                    names=["doc_id", "item_id", "distance", "n_places"],
                )

        return rows.mapInArrow(search, schema)

    found = None
    for items in _blocks(benchmark, rate, block_items, item_col, item_text_col):
        found = passed(items) if found is None else found.unionByName(passed(items))
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_items: int = BLOCK_ITEMS, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, unchanged and with all columns, in whose text no benchmark item is found.

    Items are found as by ``matches``; null and empty texts stay, repeated rows stay or go together, an empty benchmark takes
    nothing away.
    """
    def passed(rows: DataFrame, items: list) -> DataFrame:
        place = rows.columns.index(text_col)

        def clean(batches: Iterator) -> Iterator:
            import pyarrow as pa

            find = Search(items, rate)
            for batch in batches:
                yield batch.filter(pa.array([not find(normal(t.as_py())) for t in batch.column(place)], pa.bool_()))

        return rows.mapInArrow(clean, rows.schema)

    for items in _blocks(benchmark, rate, block_items, item_col, item_text_col):
        docs = passed(docs, items)
    return docs
