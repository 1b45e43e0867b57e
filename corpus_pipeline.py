"""From raw documents to a training mix: five stages over the table ``documents``.

Each stage takes what its predecessor kept, as a Parquet table, and returns the
columns of ``documents``; the last returns them with ``copy``, a row for each copy
that the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglynx.llm import decontam, mixing, quality, secretscan, simhash
from loglynx.llm.common import table
from loglynx.session import work_dir

ORACLE_SQL = None  # tokenizer, compressor and fingerprints have no SQL form: tests/llm/test_pipeline.py has a brute-force version


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints, the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by placeholders; every document stays."""
    return secretscan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target weights."""
    return mixing.mix(docs, weights=(1, 2, 3), max_repeat=3, seed=42)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", mask_secrets),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{work_dir(spark, name)}/docs"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
