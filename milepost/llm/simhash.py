"""SimHash near-duplicates, searched by chains of consecutive segments (the pigeonring principle).

Fingerprints of 64 bits are cut into ``distance`` + 1 segments on a ring. If two differ in at most
``distance`` bits, some segment starts a chain in which the first l segments together differ in at most
l - 1 bits, for every l. So the first segment agrees and the second differs in at most one bit: both
form one key of an equi-join, with the one-bit changes made on one side. The later budgets and at last the
whole distance are checked on the joined pair, which is kept only at its first such start.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.components import components
from milepost.operators.scratch import written

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 100_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit number; no words: 0."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        cuts = [(0, len(joined))]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cuts = list(zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(cuts), BLOCK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in cuts[at : at + BLOCK]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cuts), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, fingerprint bigint) and the columns of ``keep`` of every row; null or blank texts have fingerprint 0."""
    def mapped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint", *keep])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(mapped, "doc_id bigint, fingerprint bigint" + kept)


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    parts = distance + 1
    bounds = [-(-BITS * i // parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _chain(differing: Column, start: int, distance: int) -> Column:
    """Whether a chain starts at this segment: the first l segments differ in at most l - 1 bits, for every l."""
    segments, mask, ok = _segments(distance), 0, F.lit(True)
    for length in range(1, distance + 2):
        first, width = segments[(start + length - 1) % len(segments)]
        mask |= ((1 << width) - 1) << first
        ok &= F.bit_count(differing.bitwiseAND(F.lit(_signed(mask)).cast("bigint"))) <= length - 1
    return ok


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): every two different fingerprints of ``prints.fingerprint`` (distinct rows) within ``distance`` bits, once."""
    if not 1 <= distance < BITS:
        raise ValueError("distance must be from 1 to 63")
    segments = _segments(distance)
    at, fp = [], F.col("fingerprint")
    for start, (first, width) in enumerate(segments):
        second, room = segments[(start + 1) % len(segments)]
        part = lambda a, w: F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << w) - 1).cast("bigint"))
        at.append(F.struct(F.lit(start).alias("start"), part(first, width).alias("head"), part(second, room).alias("tail"), F.lit(room).alias("room")))
    index = prints.select(fp, F.inline(F.array(*at)))
    # A one-bit change turns an even number of ones into an odd one: only even tails are changed.
    even = F.bit_count("tail") % 2 == 0
    changes = F.when(even, F.sequence(F.lit(-1), F.col("room") - 1)).otherwise(F.array(F.lit(-1)))
    probes = index.withColumn("bit", F.explode(changes)).select(
        F.col("fingerprint").alias("other"), "start", "head", "bit",
        F.expr("IF(bit < 0, tail, tail ^ shiftleft(1L, bit))").alias("tail"),
    )
    differing = F.col("fingerprint").bitwiseXOR(F.col("other"))
    first_start, found = F.lit(False), F.lit(False)
    for start in range(len(segments)):
        here = _chain(differing, start, distance)
        first_start |= (F.col("start") == start) & here & ~found
        found |= here
    joined = index.drop("room").join(probes, ["start", "head", "tail"])
    kept = joined.where(((F.col("bit") >= 0) | (F.col("other") < F.col("fingerprint"))) & first_start)
    return kept.select(F.col("other").alias("a"), F.col("fingerprint").alias("b"))


def _named(rows: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, root, least): the component of each different fingerprint of ``rows`` and its smallest id."""
    classes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
    joined = components(links(classes.select("fingerprint"), distance))
    rooted = classes.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "id", F.coalesce("root", "fingerprint").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("id").alias("least"))
    return rooted.join(names, "root").select("fingerprint", "root", "least")


def near_duplicates(
    docs: DataFrame, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Equal fingerprints are one class before anything is compared. Null and blank texts share fingerprint 0.
    ``component_id`` is the smallest non-null id of the component (null if all are null). Repeated rows stay
    repeated; other columns are not read; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return rows.join(_named(rows, distance), "fingerprint").select(
        "doc_id", hexed.alias("fingerprint"), F.col("least").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with all columns, one for each component: the smallest id (null is largest), then the smallest hash of
    the text, then of the whole row (maps aside). Null and blank texts are one component; an empty table gives no rows."""
    plain = [F.col(f"row.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select(
        "row", F.xxhash64(*plain).alias("which"), F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit("")).alias("id_key"), F.xxhash64(f"row.`{text_col}`").alias("body")
    )
    read = keyed.select("id_key", "body", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").alias("text"))
    rows = written(fingerprints(read, shingle, keep=("id_key", "body")), "fingerprints")
    choice = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body", "id_key"))
    kept = rows.join(_named(rows, distance), "fingerprint").groupBy("root").agg(choice.alias("kept"))
    names = kept.select("kept.id_key", "kept.body")
    same = keyed.join(names, ["id_key", "body"]).groupBy("id_key", "body")
    return same.agg(F.min_by("row", "which").alias("row")).select("row.*")
