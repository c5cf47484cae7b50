"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes the documents that the stage before it kept, reads them from
the Parquet table which that stage wrote to the shared folder, and writes its
own.  The first four return the columns of ``documents``; the last one returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm.common import prepare, stored, table
from candlewick.llm.decontamination import decontaminate
from candlewick.llm.language_id import language_stage
from candlewick.llm.line_dedup import line_dedup as drop_repeated_lines
from candlewick.llm.minhash_dedup import minhash_dedup
from candlewick.llm.packing import pack_documents
from candlewick.llm.queries import tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Stages 1 and 5 (language models, tokenizer) can't be stated in SQL; tests/llm holds the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
