"""Language identification with bit-sliced Bloom filters of character n-grams.

One table of slots serves all languages: bit l of a slot says that an n-gram of language l falls there. The
AND over an n-gram's slots is a mask of every language that may contain it. Per-language counts of these
bits over a text, corrected for the filters' false positives, decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled documents of one language that are learned from, about; a language with fewer gives all.
SAMPLE_DOCS = 1_500
#: N-gram lengths in characters; words are set off by one space at either side.
SIZES = (3, 4, 5)
#: N-grams kept per language and length: the most frequent ones.
GRAMS = 4_000
#: Slots of the filters per kept n-gram of the largest language.
SLOTS_PER_GRAM = 8
HASHES = 3
LANGUAGES_PER_WORD = 64
UNKNOWN = "und"
#: Characters looked at in one step.
BLOCK = 1 << 20


def _letters():
    """Code point to its letter, anything else to a space."""
    import numpy as np

    codes = np.arange(0x110000, dtype=np.uint32)
    keep = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(keep, codes, 32).astype(np.uint32)


_LETTERS = None


def _codes(low: str, after_space: bool):
    """Letters of lower-case text as code points, each run of anything else as one space; none where one stands before."""
    import numpy as np

    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letters()
    codes = _LETTERS[np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)]
    space = codes == 32
    return codes[~(space & np.concatenate(([after_space], space[:-1])))]


def _grams(codes, size: int):
    """A 64-bit hash of every n-gram of ``size`` characters that is not across words."""
    import numpy as np

    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ codes[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = np.ones(n, bool)
    for k in range(1, size - 1):
        inside &= codes[k : k + n] != 32
    return mixed[inside]


def grams(text: str):
    """Hashes of the n-grams of a whole text, words set off by single spaces; in blocks that bound memory and overlap by what an n-gram needs."""
    import numpy as np

    low = f" {text.lower()} "
    tail = np.empty(0, np.uint32)
    for at in range(0, len(low), BLOCK):
        codes = _codes(low[at : at + BLOCK], len(tail) > 0 and tail[-1] == 32)
        for size in SIZES:
            yield size, _grams(np.concatenate((tail[max(0, len(tail) - size + 1) :], codes)) if len(tail) else codes, size)
        if at + BLOCK < len(low):
            tail = np.concatenate((tail, codes))[1 - max(SIZES) :]


class Filters(NamedTuple):
    """The bit-sliced filters: ``slots`` rows of language words, the languages and each one's false-positive rate."""

    languages: list[str]
    slots: object
    false_rate: object

    def masks(self, hashes):
        """For each n-gram the words of its language mask."""
        import numpy as np

        size, mask = np.uint64(len(self.slots)), None
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            found = self.slots[((hashes + np.uint64(k) * step) % size).astype(np.int64)]
            mask = found if mask is None else mask & found
        return mask

    def counts(self, text: str):
        """(n-grams, per-language popcounts) of a whole text."""
        import numpy as np

        total, hits = 0, np.zeros(len(self.languages), np.int64)
        for _, hashes in grams(text):
            if len(hashes):
                masks = self.masks(hashes)
                total += len(hashes)
                for at in range(len(self.languages)):
                    word, bit = divmod(at, LANGUAGES_PER_WORD)
                    hits[at] += int(np.count_nonzero(masks[:, word] & np.uint64(1 << bit)))
        return total, hits

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the largest corrected share of n-grams, and its part of all shares."""
        import numpy as np

        if not text or not self.languages:
            return UNKNOWN, 0.0
        total, hits = self.counts(text)
        if not total:
            if not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0
            return self.languages[0], 0.0
        share = np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0, 1)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best] / share.sum()) if share.sum() else 0.0


def build(kept: dict[str, list[int]]) -> Filters:
    """Filters of the n-gram hashes kept per language; the first language in order wins ties."""
    import numpy as np

    languages = sorted(kept)
    most = max((len(v) for v in kept.values()), default=0)
    size = max(64, SLOTS_PER_GRAM * most) | 1
    slots = np.zeros((size, -(-max(len(languages), 1) // LANGUAGES_PER_WORD)), np.uint64)
    rates = np.zeros(len(languages))
    for at, language in enumerate(languages):
        word, bit = divmod(at, LANGUAGES_PER_WORD)
        hashes = np.array(kept[language], np.int64).view(np.uint64)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            slots[((hashes + np.uint64(k) * step) % np.uint64(size)).astype(np.int64), word] |= np.uint64(1 << bit)
        rates[at] = (np.count_nonzero(slots[:, word] & np.uint64(1 << bit)) / size) ** HASHES
    return Filters(languages, slots, rates)


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, grams_kept: int = GRAMS, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from rows with text and language: about ``sample_docs`` different texts of each language, chosen by a hash of the text.

    Copies count as one text. All languages of the rows are learned. What reaches the driver is bounded by languages x lengths x ``grams_kept``.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r[0]: r[1] for r in rows.select("lang", F.xxhash64("text")).distinct().groupBy("lang").count().collect()}
    if not sizes:
        return build({})
    parts = 1 << 20
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(parts, -(-parts * sample_docs // n)))])
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(parts)) < F.element_at(limits, F.col("lang"))).distinct()

    def counted(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            gathered: dict[tuple[str, int], list] = {}
            for text, lang in zip(batch.column(0), batch.column(1)):
                for size, hashes in grams(text.as_py()):
                    gathered.setdefault((lang.as_py(), size), []).append(hashes)
            for (lang, size), found in gathered.items():
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array([size] * len(n), pa.int32()), pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "size", "gram", "n"],
                )

    counts = chosen.mapInArrow(counted, "lang string, size int, gram bigint, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    kept: dict[str, list[int]] = {lang: [] for lang in sizes}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= grams_kept).select("lang", "gram").collect():
        kept[r.lang].append(r.gram)
    return build(kept)


def held_out(doc_id: str) -> Column:
    """Whether a document is never learned from: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row, from its whole text alone.

    Null texts and texts without a letter, and all texts where nothing was learned, are ``und`` with score 0. Null ids
    and repeated rows keep their place; other columns are not read; an empty table gives no rows.
    """
    def mapped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [filters.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapped, "doc_id bigint, lang_pred string, score double")
