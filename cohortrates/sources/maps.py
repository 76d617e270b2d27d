"""Small lookup files: practices, deprivation, reference population."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import named

#: Deprivation key in the file's header -> column of the cohort it looks up.
DEPRIVATION_KEYS = {"patid": "PATIENT_ID", "pracid": "PRACTICE_ID"}


def latest_per_key(pairs: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of every key, by ``order``."""
    others = [c for c in pairs.columns if c not in (key, order)]
    last = pairs.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("last"))
    return last.select(key, *[F.col("last")[c].alias(c) for c in others])


def read_pairs(spark: SparkSession, path: str, key_at: int, value_at: int, sep: str) -> DataFrame:
    """Two columns of a headed file by position, with the place of each row in the file.

    Empty fields stay empty text. Rows are placed by the path of their file, the offset of their file block and their
    order within it, so the order is that of the file, or of a folder's files by name, however Spark splits them.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, sep=sep)
    key, value = raw.columns[key_at], raw.columns[value_at]
    return raw.select(
        F.coalesce(named(key), F.lit("")).alias("key"),
        F.coalesce(named(value), F.lit("")).alias("value"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")).alias("place"),
    )


def practice_pairs(pairs: DataFrame) -> DataFrame:
    """``id_a -> id_b`` as cohort ids, from ``key, value, place``; a repeated key takes its last row."""
    ids = pairs.select(
        F.concat(F.lit("p"), "key").alias("id_a"), F.concat(F.lit("p"), "value").alias("id_b"), "place"
    )
    return latest_per_key(ids, "id_a", "place")


def read_practice_map(spark: SparkSession, path: str, a_at: int = 0, b_at: int = 2, sep: str = "\t") -> DataFrame:
    return practice_pairs(read_pairs(spark, path, a_at, b_at, sep))


def clean_deprivation(value: Column) -> Column:
    """Letters, digits and underscores only."""
    return F.regexp_replace(value, r"(?U)[^\w]", "")


def read_deprivation_map(
    spark: SparkSession, path: str, key_at: int = 0, value_at: int = 1, sep: str = ","
) -> DataFrame:
    """``<patid|pracid> -> value``; practice keys get the cohort's prefix and cleaned values."""
    header = spark.read.csv(path, header=True, inferSchema=False, sep=sep).columns[key_at]
    pairs = latest_per_key(read_pairs(spark, path, key_at, value_at, sep), "key", "place")
    if header not in DEPRIVATION_KEYS:
        raise ValueError(f"deprivation key must be one of {sorted(DEPRIVATION_KEYS)}, not {header}")
    if header == "pracid":
        return pairs.select(
            F.concat(F.lit("p"), "key").alias(header), clean_deprivation(F.col("value")).alias("value")
        )
    return pairs.select(F.col("key").alias(header), "value")


def age_band(age: Column, bins: Sequence[int], labels: Sequence[str]) -> Column:
    """Label of the left-closed bin an age falls in; null outside all of them."""
    band = None
    for low, high, label in zip(bins[:-1], bins[1:], labels, strict=True):
        inside = (age >= low) & (age < high)
        band = F.when(inside, label) if band is None else band.when(inside, label)
    return band


def population_weights(population: DataFrame, bins: Sequence[int], labels: Sequence[str]) -> DataFrame:
    """Persons of the reference population per ``age, sex`` cell.

    There are at most two rows per age label, whatever the size of the population.
    """
    text = F.col("Age").cast("string")
    age = F.when(text == "90+", 90).otherwise(text.cast("int"))
    sex = F.when(F.col("Sex") == "Female", "F").when(F.col("Sex") == "Male", "M")
    return (
        population.where(text != "Total")
        .select(age_band(age, bins, labels).alias("band"), sex.alias("letter"), F.col("Count").cast("bigint").alias("n"))
        .where("band IS NOT NULL AND letter IS NOT NULL")
        .groupBy(F.concat_ws(", ", "band", "letter").alias("std_group"))
        .agg(F.sum("n").alias("weight"))
    )


def read_reference(spark: SparkSession, path: str, bins: Sequence[int], labels: Sequence[str]) -> DataFrame:
    return population_weights(spark.read.csv(path, header=True, inferSchema=False), bins, labels)
