"""Registered queries of this package, with their SQL where SQL can express them.

A query only applies its operator to whole tables and derives the columns its contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    token_files,
    toxicity,
    warc,
)
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.documents_as_files(table(spark, sf_dir, "documents")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "similarity", "first_word", "n_words")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_quality_rules": (op1_quality_rules, quality_rules.oracle_sql()),
    "op2_line_dedup": (op2_line_dedup, line_dedup.ORACLE_SQL),
    "op3_quality_classifier": (op3_quality_classifier, None),
    "op4_license_scan": (op4_license_scan, None),
    "op5_simhash_dedup": (op5_simhash_dedup, None),
    "op6_html_extraction": (op6_html_extraction, None),
    "op7_token_files": (op7_token_files, None),
    "op8_packing": (op8_packing, None),
    "op9_decontamination": (op9_decontamination, None),
    "op10_warc": (op10_warc, warc.ORACLE_SQL),
    "op11_toxicity": (op11_toxicity, None),
    "op12_prefix_trie": (op12_prefix_trie, prefix_trie.ORACLE_SQL),
    "op13_hard_negatives": (op13_hard_negatives, hard_negatives.ORACLE_SQL),
}
