"""Removal of boilerplate lines by the number of distinct sites that carry them.

One aggregation merges HyperLogLog sketches of sites and of documents per line hash, where documents with the same set of
lines count as one. Estimates far from the limit decide; lines near it get exact distinct counts. So a line is boilerplate
where many sites and many different documents have it, and whole copies of one document, however widely spread, are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.scratch import written

#: A line on at least so many sites, in at least so many different documents, is boilerplate.
SITES = 10
#: Size of the sketches (log2 of registers): a standard error of 1.6 %.
LG_K = 12
#: Estimates within this share of the limit (and within 2) are counted exactly.
NEAR = 0.15
BLANK = " \t\r\x0b\x0c"


def _key(line: Column) -> Column:
    """What makes lines equal: the text without white space at its ends."""
    return F.btrim(line, F.lit(BLANK))


def _lines(rows: DataFrame) -> DataFrame:
    """One row per non-blank line: doc, body and chars of its text, pos, line hash (h, h2), hashes of the site and of the text's set of lines."""
    keys = F.transform(F.split("text", "\n"), lambda x: _key(x))
    hashed = F.transform(keys, lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("h"), F.hash(x).alias("h2"), (x == "").alias("blank")))
    full = rows.select(
        "doc", F.xxhash64("site").alias("site"), F.xxhash64("text").alias("body"), F.length("text").alias("chars"),
        F.filter(hashed, lambda x: ~x["blank"]).alias("lines"),
    )
    whole = F.xxhash64(F.array_sort(F.array_distinct(F.col("lines.h"))))
    return full.select("doc", "site", "body", "chars", whole.alias("whole"), F.inline("lines")).drop("blank")


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(h, h2, first): hashes of the boilerplate lines and the smallest document id of each."""
    margin = max(2, round(NEAR * sites))
    merged = lines.groupBy("h", "h2").agg(
        F.count("*").alias("n"), F.min("doc").alias("first"),
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"),
        F.hll_sketch_estimate(F.hll_sketch_agg("whole", LG_K)).alias("wholes"),
    ).where(F.col("n") >= sites)
    low = F.least("sites", "wholes")
    # Few lines get so far; written once, they serve both sides and the exact counts.
    likely = written(merged.where(low > sites - margin).select("h", "h2", "first", low.alias("low")), "likely-lines")
    near = likely.where(F.col("low") < sites + margin)
    # Both kinds of distinct values in one pass: values are made distinct before they meet by line.
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("site").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("whole").alias("value")))
    within = lines.join(near.select("h", "h2"), ["h", "h2"], "left_semi").select("h", "h2", F.inline(kinds)).distinct()
    counted = within.groupBy("h", "h2").agg(F.count_if(F.col("kind") == 0).alias("sites"), F.count_if(F.col("kind") == 1).alias("wholes"))
    exact = counted.where(F.least("sites", "wholes") >= sites).select("h", "h2")
    sure = likely.where(F.col("low") >= sites + margin).select("h", "h2", "first")
    return written(sure.unionByName(near.join(exact, ["h", "h2"]).select("h", "h2", "first")), "boilerplate")


def without_boilerplate(
    docs: DataFrame, sites: int = SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """(row, text, n_lines, n_removed): each input row as a struct, its text without boilerplate, and counts.

    Lines are what newlines separate; those equal but for white space at their ends are one line. A line stays in
    the document with the smallest id that has it and goes from all others; blank lines stay. A null site is a
    site of its own; null texts stay null with 0 lines; a null id is never the first; repeated rows lose the same
    lines; columns of any other name are carried in ``row``; an empty table gives no rows.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
        F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
    )
    lines = _lines(rows)
    drops = lines.join(boilerplate(lines, sites), ["h", "h2"]).where("NOT (doc <=> first)")
    gone = drops.groupBy("doc", "body", "chars").agg(F.collect_set("pos").alias("gone"))
    marked = rows.join(
        gone.withColumnsRenamed({"doc": "g_doc", "body": "g_body", "chars": "g_chars"}),
        rows["doc"].eqNullSafe(F.col("g_doc")) & (F.xxhash64("text") == F.col("g_body")) & (F.length("text") == F.col("g_chars")),
        "left",
    )
    parts = F.split("text", "\n")
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("gone", i)), "\n")
    return marked.select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(parts)), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("bigint").alias("n_removed"),
    )


ORACLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k FROM cut),
whole AS (SELECT doc_id, string_agg(DISTINCT k, chr(10) ORDER BY k) AS lines FROM keyed WHERE k <> '' GROUP BY doc_id),
common AS (
  SELECT k, min(doc_id) AS first FROM keyed JOIN whole USING (doc_id) WHERE k <> '' GROUP BY k
  HAVING count(DISTINCT site) >= {SITES} AND count(DISTINCT lines) >= {SITES}),
marked AS (SELECT doc_id, line, pos, common.k IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN common USING (k))
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') END AS text,
       count(line) AS n_lines, count(line) FILTER (WHERE gone) AS n_removed
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""
