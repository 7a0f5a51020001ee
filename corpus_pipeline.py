"""A training corpus from ``documents``: five stages, each a table of Parquet files that the next one reads.

quality (rows scored below the threshold go), near-duplicates (one document of each group stays),
decontamination (contaminated documents go), secrets (spans are masked, n_chars follows), packing
(the result: every remaining document's place in a bin).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.llm import decontam, packing, quality, secret_scan, simhash
from cobble.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars is the new length where there was one."""
    clean = secret_scan.redact(docs)
    length = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document, or part of a long one, lies: bin_id, slot, doc_id, part, n_tokens, start, ..."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Training, star contraction and packing can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
