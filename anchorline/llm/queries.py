"""One query per operator of this package, over whole driver tables, and the SQL of some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm import (
    alignment,
    chat,
    clustering,
    decontamination,
    html_extraction,
    licenses,
    line_dedup,
    line_quality,
    near_dedup,
    packing,
    quality,
    token_counts,
    toxicity,
)
from anchorline.llm.common import table
from anchorline.sources.staging import Staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[build.__name__] = build
    return build


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), Staging(spark))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, Staging(spark))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, benchmark, Staging(spark))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs, Staging(spark)).drop("removed")


ORACLES["op6_line_dedup"] = line_dedup.SQL


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: a source's folders are the leading digits of the ids."""
    digits = F.regexp_replace(F.expr("CAST(doc_id DIV 10 AS STRING)"), "([0-9])", "$1/")
    path = F.concat("source", F.lit("/"), digits, F.col("doc_id").cast("string"), F.lit(".txt"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    return licenses.scan(docs, Staging(spark))


ORACLES["op7_licenses"] = licenses.oracle_sql(
    "SELECT doc_id, text, source || '/' || regexp_replace(CAST(doc_id // 10 AS VARCHAR), "
    "'([0-9])', '\\1/', 'g') || CAST(doc_id AS VARCHAR) || '.txt' AS path FROM documents"
)


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"), Staging(spark))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql(
        f"SELECT -1L AS conv_id, turn, role, '{said}' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.render_conversations(rows.unionByName(probe)))


ORACLES["op10_chat"] = chat.SQL


@query
def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return line_quality.line_quality(docs, labels, Staging(spark))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_path = public_tokenizers.path("byte_bpe_50k.json")
    pieces_path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, bytes_path, pieces_path, Staging(spark))


@query
def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings"), Staging(spark))


ORACLES["op13_clustering"] = clustering.SQL
