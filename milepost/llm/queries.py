"""The operators on their whole tables, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import (
    decontaminate, language, licenses, lines, matrices, negatives, packing, pieces, pii, quality, ranked, simhash, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_token_matrices")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrices.pack_matrices(table(spark, sf_dir, "documents"))


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_line_dedup", lines.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "n_removed")


@query("op7_url_filters", urls.oracle())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rule_table(spark, urls.RULES, urls.BLOCKED_SITES)
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op2_license_scans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language.train(docs.where(~language.held_out("doc_id")))
    return language.identify(docs, filters).withColumn("held_out", language.held_out("doc_id"))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


@query("op11_hard_negatives", negatives.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op12_ranked_search", ranked.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_sentencepiece")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), decoded=True)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
