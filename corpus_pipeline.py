"""Corpus preparation: toxicity, near duplicates, decontamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and all rows that the one before kept.
All stages but the last return the columns of documents; the last adds, for
every document, the words that the mix takes of it.  run() writes what a stage
returns to the checkpoint folder once, and the next stage reads that.

Null, empty and very long texts pass every stage; repeated rows and ties are
settled as the operators say; an empty table stays empty; further columns of
documents stay until the last stage, which replaces those named like its own
(size, source_size, target, taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import contamination, jaccard, mixing, secrets, toxicity
from docweave.llm._spark import drop, saved


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8 or more."""
    return jaccard.keep_one(docs, k=5, num=80, den=100)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    out = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return out
    n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words taken of each, by Sainte-Lague quotas."""
    sizes = mixing.count_words(docs.select("doc_id", "source", "text"), "text", "size")
    return mixing.mix_sources(sizes, rows=mixing.count_words(docs, "text", "size", keep_text=True))


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", contamination_stage),
    ("secret_scans", secret_stage),
    ("mixing_sources", mixing_stage),
]

ORACLE_SQL = None  # learnt and iterative stages; tests/llm/test_pipeline.py holds every stage and run() against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
            drop(before)
    return docs
