"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    bpe, chat, decontaminate, exact_dedup, jaccard, langid, licenses, manifest, packing, repair,
    secrets, sharding, warc,
)
from orderflow.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
            "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
            "n_near_items")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text").union(more)
    return chat.format_conversations(rows).drop("n_rewritten")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("shown")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_captures(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        "captured", "rank")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.digests(rows, repair.repair(repair.damage(rows)))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.Tree.of(16),
                           sharding.Tree.of(17))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(
        table(spark, sf_dir, "documents"),
        manifest.without_line_ends(F.col("doc_id"), F.col("text")))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_decontamination, op3_language_id, op4_jaccard_join, op5_chat_format,
    op6_license_scan, op7_packing, op8_exact_dedup, op9_secret_scan, op10_warc,
    op11_conversation_repair, op12_sharding, op13_merkle_manifest)}
