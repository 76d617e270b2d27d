"""Shared helpers: the folder all executors see, tables that cut lineage, and word expressions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a Java and Python character class and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run under ``spark.checkpoint.dir``, which all executors must share.

    A local session without that setting gets a folder of its own; a cluster without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("cohortrates.llm.scratch", None)
        if base is None:
            base = tempfile.mkdtemp(prefix="cohortrates-llm-")
            spark.conf.set("cohortrates.llm.scratch", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` computed once and read back from a table in the shared folder.

    What follows depends on files that outlive any executor, and reads only the columns it uses.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sheltered(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but the used ones renamed by position, and what gives them their names back.

    Other columns then cannot clash with names that an operator makes, nor differ from its inputs by case.
    """
    inner = [name if name in used else f"_c{i}" for i, name in enumerate(df.columns)]

    def restored(made: DataFrame) -> DataFrame:
        return made.select(*[F.col(a).alias(b) for a, b in zip(inner, df.columns, strict=True)])

    return df.toDF(*inner), restored


def text_of(column: str | Column) -> Column:
    """The column, null as an empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """A 128-bit key of a text, as a struct of two numbers."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value computed once although lambdas use it."""
    return F.element_at(F.transform(F.array(value), then), 1)
