"""The corpus pipeline: quality rules, language, near copies, benchmark passages, packing.

Every stage but the last returns the columns of ``documents``. ``run`` chains the
stages as they are deployed: each result is written to the shared folder and read again.

Rows are told apart by a digest of all their columns, not by ``doc_id``: rows without
an id, and different rows that share one, get verdicts of their own. Rows that are
equal in every column share theirs. Empty tables stay empty in every stage, null
and empty texts fail the quality rules, and further columns of ``documents`` stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fundlens.llm import decontaminate, jaccard, language, packing, quality_rules
from fundlens.llm.queries import TOKENIZER
from fundlens.session import cut_lineage

# Language identification and alignment are not expressible in SQL.
ORACLE_SQL = None

KEY = "_row_key"


def _row_key(docs: DataFrame) -> Column:
    """64 bits that stand for a whole row."""
    return F.xxhash64(*[F.col(c) for c in docs.columns])


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns with the row's key as ``doc_id``: what the operators take."""
    return docs.select(_row_key(docs).alias("doc_id"), *columns)


def _with_keys(docs: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the ``doc_id`` of ``found`` (left_anti: is not)."""
    keys = found.select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(keys, _row_key(docs) == keys["_found"], how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and keep enough lines of their own."""
    # Written first: a filter on the verdict would be pushed into the metrics and repeat them in itself.
    verdicts = quality_rules.quality_verdicts(_keyed(docs, "text", "source")).select("doc_id", "kept")
    return _with_keys(docs, cut_lineage(verdicts, "verdicts").where("kept"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go."""
    held_out = F.coalesce(language.id_remainder(4) == 2, F.lit(False))
    model = language.LanguageModel.fit(docs.where(~held_out))
    return language.keep_identified(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least id, nulls last; equal rows once."""
    groups = cut_lineage(jaccard.similar_components(_keyed(docs, "text")).select("doc_id", "component_id"), "groups")
    ids = docs.groupBy(_row_key(docs).alias("_key")).agg(F.min("doc_id").alias("_id"))
    known = groups.distinct().join(ids, groups["doc_id"] == ids["_key"])
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_key")).alias("_first")
    kept = known.groupBy("component_id").agg(first).select(F.col("_first._key").alias("doc_id"))
    chosen = _with_keys(docs, cut_lineage(kept, "kept")).withColumn(KEY, _row_key(docs))
    # Equal rows of one key: all but one go before the shuffle, task by task.
    place = F.row_number().over(Window.partitionBy(KEY).orderBy("doc_id"))
    return chosen.withColumn("_place", place).where("_place = 1").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.benchmark_matches(_keyed(docs, "text"), benchmark)
    return _with_keys(docs, cut_lineage(found.select("doc_id").distinct(), "passages"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 2048 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("language", identify_language),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
