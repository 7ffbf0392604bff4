"""From raw documents to packed training sequences, in five stages of the subpackage ``roadflow.llm``.

Each stage takes (spark, docs, sf_dir) and returns what goes on; all but the last return the columns of ``documents``.
Language: documents without a language go. Exact and near duplicates: one document of each group stays. Benchmark
overlaps: documents that hold a benchmark passage go. Packing: every piece of what is left, with its sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadflow.llm import decontaminate, exact_dedup, language, near_dedup, packing
from roadflow.session import staged


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.with_language(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.documents_packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# SQL cannot express the language model, the signatures or the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
