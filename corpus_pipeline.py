"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, packing.

Every stage takes what the one before kept, written as Parquet and read again; all but the last return the
columns of ``documents``, whatever further columns there are and whatever their names.

Odd rows have one result at every stage: an empty table stays empty, repeated rows are treated alike, a missing id is kept
and ranks last where the smallest id is wanted, and a text of any length is looked at whole. What a null or empty text
comes to is said by each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import decontaminate, lines, packing, quality, simhash
from milepost.operators.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest, unchanged. Null, empty and short texts fail the base rules;
    documents without a label count for the forest only; without labels of both kinds only the base rules decide."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites repeat; one that had nothing else goes, one that was empty or null stays.
    Of all documents with such a line the smallest id keeps it, in all its rows; ``n_chars`` follows a changed text."""
    found = lines.without_boilerplate(docs)
    text = F.col("text")
    left = found.where((F.col("n_removed") == 0) | (F.regexp_replace(text, r"\s+", "") != ""))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast("bigint")).otherwise(F.col("row.n_chars"))}
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, of equal ids the smallest hash of the text. Null and
    blank texts are one group."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, unchanged; null and empty texts and items match nothing."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, with their place in the packed sequences; a null or empty text is one piece, its end id."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Tokenizing, fingerprints and the forest have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
