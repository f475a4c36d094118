"""The queries of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.llm import (alignment, decontaminate, fingerprints, jaccard, packing, page_text, quality, secret_scan,
                         sharding, token_counts, toxicity, vector_codes, warc)
from meterdw.llm.common import table

SHARDS = 24


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.interleave(rows, SHARDS, carry=("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, folder, "documents"))


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(table(spark, folder, "pages"))
    return records.select(F.col("record").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("kind").alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.main_text(table(spark, folder, "pages"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find(table(spark, folder, "documents"))
    base = [rule.kind for rule in secret_scan.BASE]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    based = listed(F.filter("spans", lambda s: s.kind.isin(base)))
    return found.select("doc_id", *map(count, base), F.sha2(based.cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counts(table(spark, folder, "documents"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_corpus(table(spark, folder, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_sharding, op3_decontamination, op4_quality, op5_fingerprints, op6_jaccard,
                            op7_warc, op8_toxicity, op9_page_text, op10_secrets, op11_token_counts,
                            op12_alignment, op13_vector_codes)}
