"""Corpus pipeline: documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldstat.llm import stages
from fieldstat.llm.common import documents, stored

STAGES = [
    ("quality classifier", stages.keep_quality),
    ("exact dedup", stages.drop_copies),
    ("simhash near-dedup", stages.drop_near_copies),
    ("secret scans", stages.redact_secrets),
    ("best-fit packing", stages.pack_sequences),
]

#: The classifier, SimHash and the tokenizer are beyond SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
