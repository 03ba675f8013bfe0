"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import (
    conversation_repair,
    html_text,
    language_id,
    merkle,
    minhash_dedup,
    mixing,
    packing,
    quality,
    repeated_passages,
    secret_scan,
    sharding,
    vector_dedup,
    vector_search,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.predictions(docs, language_id.learnt(docs), ["doc_id"])
    return found.selectExpr("doc_id", f"{language_id.HELD_OUT} AS held_out", "lang_pred", "score")


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.with_spans(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    counts = [secret_scan.number("secret_spans", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS]
    base = F.sha2(secret_scan.written("secret_spans", 3), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secret_scan.written("secret_spans").alias("spans"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.selectExpr("page_id", "url", "text", "CAST(length(text) AS BIGINT) AS n_chars")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, ["doc_id"], quality.learnt(docs))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").selectExpr(
        "doc_id",
        "CAST(coalesce(octet_length(text), 0) + 8 AS BIGINT) AS size",
        "crc32(CAST(coalesce(text, '') AS BINARY)) AS text_crc32",
        "'key' AS law",
    )
    now = sharding.even_topology()
    shards = sharding.placed(sharding.placed(docs, "doc_id", now), "doc_id", sharding.grown(now), "grown_shard")
    return sharding.with_slots(shards, "shard", ["doc_id", "text_crc32", "size"])


def op6_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"), words=4)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), tokenizer(), ["doc_id"])
    return packing.packed(cut)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(mixing.sized(table(spark, folder, "documents")), ["doc_id"])
    return mix.selectExpr("doc_id", "size", "source_size", "target", "taken", "get(finishes, 0) AS first_finish")


def op10_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.nearest(table(spark, folder, "embeddings"), "vec_id % 100 = 0")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damaged(conversations))


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_passages.repeats(table(spark, folder, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = [c if c != "text" else f"translate(text, '{upper}', '{upper.lower()}')" for c in docs.columns]
    tampered = f"IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 0, {merkle.leaf_digest(lowered)}, NULL)"
    return merkle.verified(merkle.manifest(docs, tampered=tampered))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_language_id, op2_secret_scan, op3_html_text, op4_quality, op5_sharding, op6_vector_dedup,
        op7_minhash_dedup, op8_packing, op9_mixing, op10_vector_search,
        op11_conversation_repair, op12_suffix_dedup, op13_merkle_manifest,
    )
    return {f.__name__: f for f in operators}
