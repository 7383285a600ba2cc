"""Corpus pipeline: five stages over ``documents``, each over all that the last one kept.

Toxic documents go; of near duplicates one stays; documents with benchmark passages go;
personal data is masked; what is left is packed into sequences. Every stage is written
as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaitmill.llm import decontaminate, omh_dedup, packing, pii, toxicity
from gaitmill.llm.tables import BPE_JSON, BPE_RANKS, CAPACITY, table, tokenizer_path
from gaitmill.operators.shared import settle


def clean_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score 0.5 or more."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    return omh_dedup.without_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Marks in the place of personal data; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece."""
    return packing.pack_documents(
        docs, tokenizer_path(BPE_JSON), tokenizer_path(BPE_RANKS), CAPACITY
    )


STAGES = [
    ("toxicity", clean_toxicity),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: Alignment, learned models and packing are not SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
