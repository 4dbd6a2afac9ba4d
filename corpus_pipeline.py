"""A training corpus from the documents table, stage by stage.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), works on all rows of
``docs`` and returns those that go on, with the columns of documents; the last returns token
ids. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatlake.llm import bpe, decontam, outliers, rlz, simhash
from chatlake.llm.common import table
from chatlake.session import staged_path

# None: hashes of shingles, covariance estimates and byte-pair merges have no SQL form; the
# stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return outliers.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents whose SimHash fingerprints are linked, the one with the least id."""
    return simhash.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids have."""
    return rlz.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exchanged numbers and names included."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length and hashes of the byte-level BPE ids of every text, and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest(bpe.encode(docs, path), path)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = staged_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
