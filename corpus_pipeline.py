"""Documents made ready for training, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import bpe, decontaminate, langid, secret_scan, simhash
from orderlens.llm.common import table
from orderlens.llm.queries import VOCABULARY
from orderlens.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a letter are rejected.

    The text alone decides, so equal texts stay or go together.
    """
    return langid.determined(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id; see ``simhash.distinct``."""
    return simhash.distinct(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage stands."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secret_scan.redacted(docs, secret_scan.learn(docs))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, their number, and the digests of the ids and the decoded text."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

ORACLE_SQL = None
"""SQL cannot express the stages; tests compare them with plain versions."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
