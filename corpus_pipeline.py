"""From raw documents to packed token sequences. Every stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterdw.llm import decontaminate, jaccard, packing, quality, secret_scan
from meterdw.llm.common import staged, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the least id stays."""
    return jaccard.one_per_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secret_scan.redacted(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", redact_secrets),
    ("packing", pack_tokens),
]
# tokenizer, model and alignment have no SQL form; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
