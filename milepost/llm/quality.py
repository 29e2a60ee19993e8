"""Quality rules with an isolation forest on rule statistics.

Documents that random splits of the statistics isolate early are anomalous. The forest grows on a bounded
sample; the score above which a document is rejected is calibrated on all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from milepost.operators.scratch import written

TREES = 128
#: Rows that each tree splits.
TREE_ROWS = 256
#: Rows sampled for the forest: those with the smallest hashes.
SAMPLE_ROWS = 16_384
HASH_PARTS = 1 << 30
#: Share of good labelled rows that the threshold may reject.
GOOD_LOSS = 0.005
#: Scores are compared in steps of one over this.
STEPS = 2_000
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "top_word", "stutter")
#: What the forest splits. Repeated lines and windows are left to the base rules: much good text has a few.
SPLIT = ("word_length", "symbols", "capitals", "marks", "top_word", "stutter")
STATISTICS = ", ".join([f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in SHARES])


def repeated_words(ids, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    import numpy as np

    if len(ids) < 4:
        return 0
    pairs, base = ids[:-2] * distinct + ids[1:-1], distinct * distinct
    if base * distinct >= 1 << 62:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + len(twice)] |= twice
    return int(inside.sum())


def statistics(text: str | None) -> tuple:
    """COUNTS and SHARES of a whole text; words are what ASCII white space separates, null has none."""
    import numpy as np

    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(SHARES)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup_lines, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    repeats = repeated_words(ids, len(numbers))
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (
        chars / n, symbols / n, dup_lines / lines, repeats / n, codes[65:91].sum() / chars,
        (codes[33] + codes[63]) / n, (np.bincount(ids).max() - 1) / n, (ids[1:] == ids[:-1]).sum() / n,
    )
    return (n, chars, symbols, dup_lines, repeats, *map(float, shares))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS and SHARES of every row."""
    names = ["doc_id", *COUNTS, *SHARES]

    def mapped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            columns = list(zip(*(statistics(t.as_py()) for t in batch.column(1)))) or [()] * (len(names) - 1)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(SHARES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapped, f"doc_id bigint, {STATISTICS}")


def expected_path(rows):
    """Mean path length of an unsuccessful search among ``rows`` rows."""
    import numpy as np

    rows = np.maximum(np.asarray(rows, float), 1.0)
    harmonic = np.log(np.maximum(rows - 1, 1)) + np.euler_gamma
    return np.where(rows > 2, 2 * harmonic - 2 * (rows - 1) / rows, np.where(rows > 1, 1.0, 0.0))


class Forest(NamedTuple):
    """Trees as tables: the split of each node, its children (itself for a leaf) and the path length at it."""

    column: object
    cut: object
    low: object
    high: object
    path: object
    depth: int
    usual: float

    def scores(self, rows):
        """Anomaly scores from 0 to 1; 0.5 is usual."""
        import numpy as np

        rows = np.asarray(rows, float)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for tree in range(len(self.column)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                below = rows[every, self.column[tree][node]] < self.cut[tree][node]
                node = np.where(below, self.low[tree][node], self.high[tree][node])
            total += self.path[tree][node]
        return np.exp2(-total / len(self.column) / self.usual)


def grow(rows, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """An isolation forest: a random column and a random cut within its range, down to the mean depth."""
    import numpy as np

    rows, rng = np.asarray(rows, float), np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    tables = ([], [], [], [], [])
    for _ in range(trees):
        table = ([], [], [], [], [])
        waiting = [(rng.choice(len(rows), size, replace=False), 0)]
        made = 1
        for at in range(1 << (depth + 1)):
            if at >= len(waiting):
                break
            part, level = waiting[at]
            values = rows[part]
            spread = np.flatnonzero(values.min(0) < values.max(0)) if len(part) > 1 else []
            if level == depth or not len(spread):
                entry = (0, math.inf, at, at, level + float(expected_path(len(part))))
            else:
                column = int(rng.choice(spread))
                cut = rng.uniform(values[:, column].min(), values[:, column].max())
                below = values[:, column] < cut
                waiting += [(part[below], level + 1), (part[~below], level + 1)]
                entry = (column, cut, made, made + 1, 0.0)
                made += 2
            for cells, cell in zip(table, entry):
                cells.append(cell)
        for cells, column in zip(tables, table):
            cells.append(np.array(column))
    return Forest(*tables, depth, float(expected_path(size)) or 1.0)


class Rules(NamedTuple):
    """A fitted forest and the score above which documents are rejected."""

    forest: Forest | None
    threshold: float


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _scored(measured: DataFrame, forest: Forest | None) -> DataFrame:
    """``measured`` with ``score``; 0 for every row where there is no forest."""
    def mapped(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            shares = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in SPLIT]
            scores = forest.scores(np.stack(shares, 1)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return measured.mapInArrow(mapped, f"doc_id bigint, {STATISTICS}, score double")


def fit(
    measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, good_loss: float = GOOD_LOSS,
    label_id: str = "doc_id", label: str = "quality",
) -> Rules:
    """Forest from the statistics of at most ``sample_rows`` rows (those with the smallest hashes of a part of all), threshold
    from all labelled rows.

    ``measured`` is the written result of ``with_statistics``. The threshold is the one with the largest sum of
    bad rows rejected and good rows kept (shares), among those that reject at most ``good_loss`` of the good
    rows that pass the base rules. Without labelled rows of both kinds nothing is rejected by the forest.
    """
    whole = measured.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    order = F.xxhash64(F.col("doc_id"), *COUNTS)
    # Of many rows only about four times the sample meets at the driver, however many tasks there are.
    part = int(min(1.0, 4 * sample_rows / max(whole.count(), 1)) * HASH_PARTS)
    likely = whole.where(F.pmod(order, F.lit(HASH_PARTS)) < part)
    sample = likely.select(*SPLIT).orderBy(order, *SPLIT).limit(sample_rows).collect()
    if len(sample) < 2:
        return Rules(None, math.inf)
    forest = grow([tuple(r) for r in sample])
    known = labels.select(F.col(label_id).cast("bigint").alias("doc_id"), F.col(label).alias("good")).where("good IN (0, 1)")
    step = F.floor(F.col("score") * STEPS).alias("step")
    # Both sides grow with the corpus; the size of a compressed file says little about the label table in memory.
    met = _scored(whole, forest).select("doc_id", step).join(known.hint("merge"), "doc_id")
    counted = met.groupBy("step", "good").count().collect()
    good, bad = ({r["step"]: r["count"] for r in counted if r["good"] == k} for k in (1, 0))
    if not good or not bad:
        return Rules(forest, math.inf)
    n_good, n_bad, lost, caught, best, threshold = sum(good.values()), sum(bad.values()), 0, 0, 0.0, math.inf
    for at in sorted({*good, *bad}, reverse=True):
        lost, caught = lost + good.get(at, 0), caught + bad.get(at, 0)
        if lost > good_loss * n_good:
            break
        if caught / n_bad - lost / n_good > best:
            best, threshold = caught / n_bad - lost / n_good, at / STEPS
    return Rules(forest, threshold)


def judged(measured: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and score of every measured row."""
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    limit = F.lit(float(rules.threshold))
    return _scored(measured, rules.forest).select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") < limit)).alias("kept"), "score"
    )


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's counts and verdict.

    Null and blank texts have no words and fail the base rules; null ids are judged but not labelled; repeated
    rows and labels count as often as they occur; other columns are not read; an empty table gives no rows.
    """
    measured = written(with_statistics(docs, id_col, text_col), "statistics")
    return judged(measured, fit(measured, labels))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` keeps, unchanged and with all columns, nulls and repeated rows as there.

    Rows are written once with their statistics, the rules are fitted on these narrow columns, and the written rows are
    filtered by them: each text is measured once and no text is shuffled.
    """
    kinds = [*[LongType()] * len(COUNTS), *[DoubleType()] * len(SHARES)]
    measure = F.arrow_udf(_measured, StructType([StructField(c, k) for c, k in zip((*COUNTS, *SHARES), kinds)]))
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = written(docs.select(whole, measure(docs[text_col]).alias("measured")), "measured-rows")
    rules = fit(rows.select(F.col(f"row.`{id_col}`").cast("bigint").alias("doc_id"), "measured.*"), labels)
    failed = base_failed(F.col("measured.n_words"), F.col("measured.n_repeat_words"))
    if rules.forest is None:
        return rows.where(~failed).select("row.*")
    forest = rules.forest

    def score(*shares):
        import numpy as np
        import pyarrow as pa

        return pa.array(forest.scores(np.stack([s.to_numpy(zero_copy_only=False) for s in shares], 1)))

    scored = rows.withColumn("score", F.arrow_udf(score, "double")(*[F.col(f"measured.{c}") for c in SPLIT]))
    return scored.where(~failed & (F.col("score") < F.lit(float(rules.threshold)))).select("row.*")


def _measured(texts):
    """Statistics of a batch of texts as a struct array."""
    import pyarrow as pa

    columns = list(zip(*(statistics(t.as_py()) for t in texts))) or [()] * (len(COUNTS) + len(SHARES))
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(SHARES)
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*COUNTS, *SHARES])
