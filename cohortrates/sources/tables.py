"""Reading cohort extracts and writing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import date_pattern, named

CONDITION_PREFIX = "BD_"

#: Files whose headers are read at a time.
HEADERS = 16

MALFORMED = "_malformed"


@dataclass(frozen=True)
class CsvScan:
    """Well-formed rows, every column as text, and the malformed ones: ``file`` and ``row`` as it stands there."""

    rows: DataFrame
    malformed: DataFrame


def _headers(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header; each file's first line is read, and nothing else."""

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.csv(file, header=True, inferSchema=False, sep=sep).columns)

    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS) as pool:
        for file, columns in zip(files, pool.map(header, files), strict=True):
            if columns:  # else the file is empty
                found.setdefault(columns, []).append(file)
    if not found:
        raise ValueError(f"no file with a header: {path}")
    return found


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> CsvScan:
    """A CSV file with a header, or a folder of them, whose columns may stand in different orders.

    Columns go by the name in each file's own header, in the order of the first file. Files that lack or add a column
    are an error. A row with more or fewer fields than its header, or an unclosed quote, is malformed.
    """
    by_header = _headers(spark, path, sep)
    names = min(by_header.items(), key=lambda item: item[1][0])[0]
    parts, bad = [], []
    for header, files in by_header.items():
        if sorted(header) != sorted(names):
            raise ValueError(f"{files[0]} has the columns {list(header)}, other files have {list(names)}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
        reader = spark.read.schema(schema).options(header=True, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
        # all fields are parsed whatever is selected, or rows would be malformed for some queries only
        raw = reader.option("columnPruning", False).csv(files)
        # with nothing added, but never the only column of a query, which Spark refuses
        row = F.concat(named(MALFORMED), F.coalesce(F.substring(named(header[0]), 1, 0), F.lit("")))
        parts.append(raw.where(row.isNull()).select(*[named(c) for c in names]))
        bad.append(raw.where(row.isNotNull()).select(F.col("_metadata.file_path").alias("file"), row.alias("row")))
    return CsvScan(reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, bad))


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """The rows of ``read_csv``: every column as text and empty fields as null. A malformed row fails the query."""
    found = read_csv(spark, path, sep)
    message = F.concat(F.lit("malformed row in "), "file", F.lit(": "), "row")
    failed = found.malformed.select(*[F.raise_error(message).cast("string").alias(c) for c in found.rows.columns])
    df = found.rows.unionByName(failed)
    return df.select(*[named(c) for c in columns]) if columns else df


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[named(c) for c in columns]) if columns else df


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV or parquet source, told apart by its name."""
    if path.rstrip("/").endswith(".csv"):
        return scan_csv(spark, path, columns)
    if path.rstrip("/").endswith(".parquet"):
        return scan_parquet(spark, path, columns)
    raise ValueError(f"neither .csv nor .parquet: {path}")


def ingest_dates(df: DataFrame, columns: Sequence[str], fmt: str = "%Y-%m-%d") -> DataFrame:
    """Text columns parsed to dates by one format; columns that are dates already stay as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pattern = date_pattern(fmt)
    changes = {}
    for name in columns:
        if isinstance(types[name], T.StringType):
            changes[name] = F.to_date(named(name), pattern)
        elif not isinstance(types[name], T.DateType):
            changes[name] = named(name).cast("date")
    return df.withColumns(changes) if changes else df


def discover_conditions(df: DataFrame, prefix: str = CONDITION_PREFIX) -> list[str]:
    """Condition columns, found by their prefix in the schema alone."""
    return [c for c in df.columns if c.startswith(prefix)]


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One CSV file with a header, in the given order of rows; nulls are empty, empty strings are quoted.

    Tasks write the sorted parts. The parts are then copied into one file behind the header, a buffer at a time,
    and that file takes the place of an older one in a single step. So a write that fails leaves the older file.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    work = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    target, parts, whole = (jvm.org.apache.hadoop.fs.Path(p) for p in (path.rstrip("/"), f"{work}.parts", f"{work}.tmp"))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    system = target.getFileSystem(conf)
    if system.exists(target) and system.getFileStatus(target).isDirectory():
        raise FileExistsError(f"a folder stands in the place of the file {path}")
    try:
        rows = df.orderBy(*[named(c) for c in order]) if order else df
        rows.write.option("header", False).csv(parts.toString())
        header = spark.createDataFrame([tuple(df.columns)], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(df.columns))]))
        header.coalesce(1).write.option("header", False).csv(f"{work}.parts/header")
        out = system.create(whole)
        try:
            for folder in (jvm.org.apache.hadoop.fs.Path(parts, "header"), parts):
                for name in sorted(s.getPath().getName() for s in system.listStatus(folder)):
                    if name.startswith("part-"):
                        part = system.open(jvm.org.apache.hadoop.fs.Path(folder, name))
                        try:
                            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                        finally:
                            part.close()
        finally:
            out.close()
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(system.makeQualified(whole), system.makeQualified(target), overwrite)
    finally:
        system.delete(parts, True)
        system.delete(whole, False)


def parquet_to_csv(spark: SparkSession, source: str, target: str, order: Sequence[str] = ()) -> None:
    write_csv(spark.read.parquet(source), target, order)


