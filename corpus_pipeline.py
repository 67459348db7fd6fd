"""A corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.llm import decontaminate, near_dup, packing, quality_rules, substring_dedup
from spherecube.llm.common import small_side, stored
from spherecube.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor are rejected by the learned list."""
    assessed = quality_rules.assess(docs, table(spark, sf_dir, "labels"))
    return assessed.filter("_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; a null id counts as its own document."""
    found = near_dup.near_duplicates(docs)
    gone = stored(found.filter(~F.col("kept")).select("doc_id").distinct(), "copies")
    return docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that near-repeat one of an earlier document; texts of which nothing is left go."""
    spans = stored(substring_dedup.repeated_passages(docs), "passages")
    cut = substring_dedup.without_passages(docs, spans)
    left = cut.filter((F.col("_cut") == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        size = F.when(F.col("_cut") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", size)
    return left.select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a window of a benchmark item."""
    marked = decontaminate.annotate(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter(F.col("_leak.n_hit") == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packing_stage),
]

#: learned rules and tokenizers have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
