"""The corpus pipeline: five operators in a row, each stage written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from slabworks.llm import bpe, decontam, langid, neardup, secrets
from slabworks.llm.common import run_dir, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told.

    Null and empty texts and those without a letter are rejected; repeated rows get one verdict.  Without a labelled
    document to learn from nothing is rejected.  An empty table stays empty.
    """
    return langid.accepted(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, similarity 0.8).

    That is the one with the smallest doc_id (null ids come last, then the text's hash decides); of repeated rows one
    stays.  Texts without words, null ones included, are linked with nothing and all stay.
    """
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item, all rows of such a text; null and empty texts stay."""
    return decontam.without_leaks(docs, decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking secrets by a mark; all documents stay, null and empty texts and repeated rows as they are."""
    return secrets.redact(docs, secrets.find_secrets(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of what they decode to; a null text is empty, repeated rows stay."""
    return bpe.encode_documents(docs, *bpe.production())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scan", secret_scan), ("encode", encode)]

#: Networks, sketches and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{run_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
