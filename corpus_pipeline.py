"""A corpus pipeline: from raw documents to packed training windows.

Each stage takes the rows that the one before kept, as read back from Parquet, and returns the rows that
stay with the columns of documents; the last returns the packed pieces. Executors that are lost cost a
stage's tasks, never an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortrates.llm import decontaminate, line_dedup, packing, quality_classifier, simhash
from cohortrates.llm.common import settled, table


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the classifier's threshold go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; every document stays, with its text and length made anew."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents that are left, packed into windows."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", drop_shared_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. What each stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs


#: Fingerprints, alignment and tokens are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None

QUERIES = {"pipeline": (run, ORACLE_SQL)}
