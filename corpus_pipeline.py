"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on what its predecessor kept and returns the columns of documents, but for the
last, which returns the packed pieces. `run` writes each stage's rows but the last one's as a table of the shared
folder and rereads them, so that no stage is computed again by the next one's passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm import language_id, minhash_dedup, mixing, packing, queries, secret_scan, storage

#: No SQL expresses the language model, the sketches and the genetic packing; tests use brute force.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go. lang is what the model says."""
    found = language_id.identify(docs, language_id.learnt(docs))
    kept = found.where(f"lang_pred <> '{language_id.UNDETERMINED}'")
    return kept.drop("lang").withColumnRenamed("lang_pred", "lang").select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    found = minhash_dedup.near_duplicates(docs)
    gone = found.where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by a mark."""
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the mix."""
    return mixing.stream(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in the training sequences."""
    return packing.packed(packing.pieces(docs, queries.tokenizer(), ["doc_id"]))


STAGES = [
    ("language_id", identified),
    ("minhash_dedup", deduplicated),
    ("secret_scan", cleaned),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = storage.written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
