"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession

from ratepanel.llm import bpe, decontam, minhash, quality, secrets
from ratepanel.llm.frames import ship, table
from ratepanel.sources.shared import fresh_path

VOCABULARY = "byte_bpe_50k.tiktoken"


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship(spark)
    return quality.quality_filter(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship(spark)
    return minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.redact(docs, secrets.fit(docs, path="source"), path="source")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids of each document."""
    ship(spark)
    return bpe.digests(docs, vocabulary(VOCABULARY), PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", reject_poor),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

#: Compression, signatures, a forest and BPE have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        where = fresh_path(spark, f"pipeline-{name}")
        stage(spark, rows, sf_dir).write.parquet(where)
        rows = spark.read.parquet(where)
    return rows
