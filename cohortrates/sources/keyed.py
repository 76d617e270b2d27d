"""Tables kept by a key, so that later joins and counts by it find rows of a key together.

Rows with a key are written bucketed and sorted by it, one file per bucket; a bucketed scan tells the planner so, and
neither a join nor a window nor an aggregate by the key deals them out again. Rows without a key would
all fall into one bucket, so they are kept apart, as they came.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import named, quoted, text

KEYED, KEYLESS, LAYOUT = "keyed", "keyless", "layout"


@dataclass(frozen=True)
class KeyedTable:
    """The rows with a key, dealt by it, and the rows without."""

    key: str
    buckets: int
    keyed: DataFrame
    keyless: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.keyed.unionByName(self.keyless)


def write_keyed(df: DataFrame, key: str, path: str, buckets: int, kind: T.DataType | None = None) -> KeyedTable:
    """Keep ``df`` by ``key`` in a folder, its key cast to ``kind`` if given; and the table that was written.

    Tables that are to be joined need the same type of key and number of buckets. A number of about a
    bucket per executor core and gigabyte keeps files of a size that a task can sort.
    """
    spark = df.sparkSession
    typed = df.withColumn(key, named(key).cast(kind)) if kind is not None else df
    name = f"cohortrates_{uuid.uuid4().hex}"
    (
        typed.where(named(key).isNotNull())
        .repartition(buckets, named(key))  # the same hash as the buckets', so one task writes one file
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .mode("overwrite")
        .option("path", f"{path}/{KEYED}")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    typed.where(named(key).isNull()).write.mode("overwrite").parquet(f"{path}/{KEYLESS}")
    spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/{LAYOUT}")
    return read_keyed(spark, path)


def read_keyed(spark: SparkSession, path: str) -> KeyedTable:
    """A table written by ``write_keyed``. Its buckets are known to the session under a name of their own."""
    layout = spark.read.parquet(f"{path}/{LAYOUT}").first()
    keyless = spark.read.parquet(f"{path}/{KEYLESS}")
    name = f"cohortrates_{uuid.uuid4().hex}"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in keyless.schema.fields)
    by = quoted(layout.key)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by} ASC) INTO {layout.buckets} BUCKETS LOCATION {text(f'{path}/{KEYED}')}"
    )
    return KeyedTable(layout.key, layout.buckets, spark.table(name), keyless)
