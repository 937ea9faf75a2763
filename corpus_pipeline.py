"""Corpus pipeline: from raw documents to packed token sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; ``docs`` is the direct read of Parquet files, so rows have a fixed place in the
scan and are numbered by it. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import exact, mixing, packing, quality, simhash
from ledgermill.llm.common import prepared, stored, table
from ledgermill.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go; it learns from the labelled ones."""
    return quality.accepted(docs, table(prepared(spark), sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    prepared(spark)
    return exact.deduplicated(docs, scanned=True)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate group the document with the smallest id stays."""
    prepared(spark)
    return simhash.one_per_group(docs, scanned=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until their sources meet their targets."""
    prepared(spark)
    return mixing.mixed(docs, scanned=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece with its place in a sequence."""
    prepared(spark)
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The classifier, the hashes and the packing order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
