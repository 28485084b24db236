"""Registered queries over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.llm import decontaminate, grades, html_text, jaccard, language, licences, lm, negatives, packing, quality_rules, repair, sharding, token_counts

from fundlens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES", "TOKENIZER"]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_matches(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.coalesce(language.id_remainder(10), F.lit(1))
    role = F.when(remainder == 0, lm.SCORED).when(remainder == 1, lm.WEIGHTS).otherwise(lm.MAIN)
    scored = lm.score_documents(table(spark, sf_dir, "documents"), role)
    held_out = F.coalesce(language.id_remainder(10) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op6_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = grades.OrdinalModel.fit(grades.rated_documents(docs, table(spark, sf_dir, "labels")))
    return grades.grade_documents(docs, model, least_grade=1)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.id_remainder(4) == 2, F.lit(False))
    model = language.LanguageModel.fit(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.hard_negatives(rows, anchors=F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_decontamination, op3_licences, op4_lm_scores, op5_quality_rules, op6_quality_grades, op7_html_text,
        op8_language, op9_jaccard, op10_sharding, op11_token_counts, op12_conversation_repair, op13_hard_negatives,
    )
}
