"""The registered queries of this subpackage and their oracle SQL.

Each ``opN_<name>`` query applies one operator, with its production
parameters, to the whole intended table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridwright.llm import (
    byte_cnn,
    cap_filters,
    chat_format,
    decontaminate,
    hilbert_shards,
    infill,
    licenses,
    mil_quality,
    ngram_join,
    packing,
    token_alignment,
    toxicity_chain,
    warc,
)
from gridwright.llm.common import table


def op1_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, by exact shingle containment."""
    found = decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_shingles", "matched", "containment")


def op2_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label, with link counts and components."""
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    return byte_cnn.identify_languages(table(spark, sf_dir, "documents"))


def op4_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity categories of every whole text."""
    return toxicity_chain.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 runs of a Hilbert order, under the law ``rows``."""
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"), 40)


def op6_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    return mil_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the documents by 5-word shingles."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back sequentially."""
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited license of every document, laid out as files by source and id."""
    found = licenses.scan_licenses(licenses.document_files(table(spark, sf_dir, "documents")))
    doc_id = F.regexp_extract("path", r"(-?\d+)\.txt$", 1).cast("bigint")
    return found.select(doc_id.alias("doc_id"), *found.columns)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every whole text, with pair counts."""
    found = token_alignment.align_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select(*[c for c in found.columns if c != "groups"], digest.alias("groups_sha256"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted and read back."""
    rows = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_conversations(rows)).withColumnRenamed("conv", "conv_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut at two lines and rearranged, and what is rebuilt from that."""
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_containment,
        op2_cap_filters,
        op3_byte_cnn,
        op4_classifier_chain,
        op5_hilbert_shards,
        op6_hierarchical_packing,
        op7_attention_mil,
        op8_ngram_jaccard,
        op9_warc_round_trip,
        op10_license_scan,
        op11_token_alignment,
        op12_chat_format,
        op13_fill_in_middle,
        pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {"op1_minhash_containment": decontaminate.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
