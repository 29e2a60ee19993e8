"""Ranked lexical search: every document scored for every item by blocked float64 multiplication, exactly.

One pass over the texts leaves, for each document, its length and its counts of the items' own terms: a compact
vocabulary that the corpus cannot widen. A second pass over these counts makes dense tiles (terms x documents) of
whole-number impacts and multiplies the items' incidence tiles (items x terms) with them. A tile is no wider than keeps
every partial sum below 2^53, where float64 adds whole numbers exactly; tiles are added up as 64-bit integers. Each task
keeps the best documents of each item, and these few rows are merged.

Items are taken in blocks of bounded text, one after the other; documents are never collected or sampled.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.best import Best, best_rows, named, unnamed
from milepost.operators.scratch import written

#: Documents and terms of a tile: 32 MB of impacts.
DOCUMENTS, TERMS = 1024, 4096
#: Characters and number of items in a block.
BLOCK_CHARS, BLOCK_ITEMS = 8_000_000, 1024
#: Whole numbers below this are exact in float64.
EXACT = 2**53

_TERM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz".encode()
#: For each byte of UTF-8 text: ASCII letters in lower case, other characters beyond ASCII as they are, the rest a space.
_FOLD = bytes(b if b >= 128 else chr(b).lower().encode()[0] if b in _TERM else 32 for b in range(256))


def terms(text: bytes | str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case."""
    blob = text.encode() if isinstance(text, str) else text or b""
    return blob.translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """``floor(1000 * ln((2N + 2) / (2df + 1)))`` in doubles."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of one term in a document's score, in whole numbers."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The documents' ``m``; beyond 64-bit products through Python's integers."""
    if len(n) and 50 * int(n.max()) * documents >= 2**63:
        return np.array([50 + 50 * int(x) * documents // total for x in n], "int64")
    return 50 + 50 * n * documents // max(total, 1)


def tile_width(weights: np.ndarray, widest: int = TERMS) -> int:
    """Terms of a tile, so that no partial sum reaches 2^53: an impact is under a million times its weight."""
    largest = int(weights.max(initial=0)) * 1_000_000
    return max(1, min(widest, (EXACT - 1) // max(largest, 1)))


def _counted(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts): the number of all terms, and the counts of the terms of the vocabulary."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = vocabulary.value
        wide = max(len(known), 1)
        for batch in batches:
            found, sizes, n = array("q"), [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                hits = [x for x in map(known.get, words) if x is not None]
                n.append(len(words))
                sizes.append(len(hits))
                found.extend(hits)
            row = np.repeat(np.arange(len(n)), sizes)
            pairs, counts = np.unique(row * wide + np.frombuffer(found, "int64"), return_counts=True)
            ends = np.searchsorted(pairs // wide, np.arange(len(n) + 1)).astype("int32")
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c, t)) for c, t in ((pairs % wide, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "counts"])

    few = docs.select(named(F.col(id_col)).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return few.mapInArrow(run, "id bigint, n bigint, terms array<int>, counts array<bigint>")


def _best(counted: DataFrame, shared, k: int) -> DataFrame:
    """(slot, score, id): of each task, the best documents of each item."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block = shared.value
        weights, items, columns = block["weights"], block["item"], block["term"]  # incidence pairs sorted by term
        n_items, width = block["items"], tile_width(block["weights"])
        heaps, slots = Best(n_items, k), np.arange(n_items)

        def offer(part) -> None:
            ids, n = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            ends = np.asarray(part.column(2).offsets)
            document = np.repeat(np.arange(len(ids)), np.diff(ends))
            term = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("int64")
            tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
            impact = impacts(weights[term], tf, lengths(n, block["documents"], block["total"])[document])
            order = np.argsort(term, kind="stable")
            term, document, impact = term[order], document[order], impact[order]
            scores = np.zeros((n_items, len(ids)), "int64")
            present = np.unique(term)
            for first in range(0, len(present), width):
                here = present[first : first + width]
                tile = np.zeros((len(here), len(ids)))
                a, b = np.searchsorted(term, [here[0], here[-1] + 1])
                tile[np.searchsorted(here, term[a:b]), document[a:b]] = impact[a:b]
                a, b = np.searchsorted(columns, [here[0], here[-1] + 1])
                at = np.searchsorted(here, columns[a:b])
                held = here[np.minimum(at, len(here) - 1)] == columns[a:b]
                incidence = np.zeros((n_items, len(here)))
                incidence[items[a:b][held], at[held]] = 1.0
                scores += (incidence @ tile).astype("int64")
            heaps.offer(slots, scores, ids, scores > 0)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                offer(batch.slice(at, DOCUMENTS))
        slot, score, ids = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (slot, score, ids)], names=["slot", "score", "id"])

    return counted.select("id", "n", "terms", "counts").where(F.size("terms") > 0).mapInArrow(run, "slot bigint, score bigint, id bigint")


def _block(items: DataFrame, k: int, docs: DataFrame, doc_id: str, doc_text: str) -> DataFrame:
    """Ranked documents of one block of items, which the driver holds."""
    spark = docs.sparkSession
    held = items.toArrow().to_pylist()
    known: dict[bytes, int] = {}
    pairs = sorted(
        (known.setdefault(t, len(known)), slot) for slot, item in enumerate(held) for t in dict.fromkeys(terms(item["text"]))
    )
    counted = written(_counted(docs, spark.sparkContext.broadcast(known), doc_id, doc_text), "term-counts")
    corpus = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pandas().itertuples(index=False))
    shared = spark.sparkContext.broadcast({
        "documents": corpus["documents"], "total": corpus["total"], "items": len(held),
        "weights": np.array([weight(corpus["documents"], holding.get(t, 0)) for t in range(len(known))], "int64"),
        "term": np.array([t for t, _ in pairs], "int64"), "item": np.array([slot for _, slot in pairs], "int64"),
    })
    best = best_rows(_best(counted, shared, k), ["slot"], "score", "id", k)
    names = spark.createDataFrame([(slot, item["id"]) for slot, item in enumerate(held)], "slot bigint, item_id bigint")
    return best.join(names, "slot").select("item_id", "rank", unnamed(F.col("id")).alias("doc_id"), "score")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_chars: int = BLOCK_CHARS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0, all if fewer.

    A score sums, over the item's different terms, the term's weight by document frequency times its saturated count in
    the document. Equal scores rank by document id. Null and empty texts have no terms: such documents do not count
    towards the corpus, such items give no rows. A missing document id ranks last among equal scores; every row of
    ``docs`` is a document of its own. An item id that stands in several rows takes the smallest of their texts. Other
    columns are not read; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).cast("string").alias("text"))
    asked = written(asked.groupBy("id").agg(F.min("text").alias("text")).where(F.length("text") > 0), "items")
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(-(-size["n"] // block_items), -(-size["chars"] // block_chars))
    number = F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1)))
    found = [_block(asked.where(number == b).orderBy("id"), k, docs, doc_id, doc_text) for b in range(blocks)]
    if len(found) > 1:
        found = [written(f, "ranked") for f in found]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


#: The query's rows in SQL.
ORACLE = r"""WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
c AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS N, CAST(sum(len(t)) AS BIGINT) AS L FROM d),
f AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(t) AS term FROM d) GROUP BY row_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY term, N),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
m AS (SELECT row_id, doc_id, 100 - 50 + ((50 * len(t) * N) // L) AS m FROM d, c),
s AS (
  SELECT item_id, row_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (row_id) GROUP BY item_id, row_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s JOIN m USING (row_id) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50"""
