"""A pipeline over `documents`: classify, clean, deduplicate, redact, pack.

Each stage reads all that its predecessor kept, from Parquet, and returns
documents' columns; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lattica.llm import bpe, packing, quality_classifier, quality_rules, secrets, simhash
from lattica.llm.common import staged, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely enough of the best grade stay."""
    return quality_classifier.filtered(docs, table(spark, sf_dir, "labels"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and so do documents that fail or lose too much."""
    return quality_rules.filtered(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, packed into sequences of 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end_id=2, capacity=1024, special=bpe.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", clean),
    ("simhash near-dedup", deduplicate),
    ("secret scans", redact),
    ("best-fit packing", pack),
]

#: SQL cannot express the classifier, fingerprints or token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name.replace(" ", "-"))
    return docs
