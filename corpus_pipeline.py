"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes the documents its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from anchorline.llm import decontamination, line_dedup, near_dedup, packing, quality
from anchorline.llm.common import table
from anchorline.sources.staging import Staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_quality(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages go; a document of nothing else goes whole."""
    return line_dedup.without_repeats(docs, Staging(spark))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return near_dedup.one_of_each(docs, Staging(spark))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.without_contaminated(docs, benchmark, Staging(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: one row per piece of a document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, Staging(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Signatures, template windows and token ids are beyond SQL; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, every result but the last written and read again."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
