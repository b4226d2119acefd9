"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark passages go, secrets are
masked in the texts, and what is left is packed into training sequences. All stages but the last return the columns that
they are given. No SQL expresses the classifier or the tokenizer, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks.llm import decontaminate, near_dedup, packing, secrets, toxicity
from martworks.llm.scratch import Scratch, tuned


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from labelled documents of the input, drop those that score 0.5 or more.

    Without labels to learn from (none, all held out, none of a document of the input, one kind only) all documents stay.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, a similarity of 0.8 or more."""
    return near_dedup.near_dedup(docs, size=5, percent=80)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaked),
    ("secrets", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(tuned(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
    return docs
