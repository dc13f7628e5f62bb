"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, packing, quality, secret_scan, simhash
from .tokens import vocabulary_path

#: SimHash contract: words of a shingle, differing bits.
SHINGLE, DISTANCE = 4, 4
#: Packing contract: tokens of a sequence, end id.
CAPACITY, END_ID = 1024, 2


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned on ``docs`` and the labels table, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicate(docs, SHINGLE, DISTANCE)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret found replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack_documents(docs, vocabulary_path("byte_bpe_50k.json"), CAPACITY, END_ID)
