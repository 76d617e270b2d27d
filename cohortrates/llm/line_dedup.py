"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z lower-cased; runs hold 128-bit
hashes of keys with the number of documents that hold them. Runs are bucketed and sorted by key, all in the same
number of buckets, so that a batch is dealt by key once, when it is counted, and meets the runs where they lie. A batch
is anti-joined with the keys already known to be shared, and joined with the runs: keys that reach the threshold with
what the runs have are shared from now on, the others become a new run. A full level is merged into one run of the next.

Batches double in size, so their number grows with the logarithm of the input.

Only DataFrame functions are used.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, let, shared_folder, sheltered, text_key, text_of

#: A key found in so many documents is boilerplate.
MIN_DOCUMENTS = 10

#: Shorter keys are never dropped.
MIN_CHARS = 1

#: Runs of one level that are merged into a run of the next.
FANOUT = 2

#: Documents of the first batch, about; each later one is twice as large.
FIRST_BATCH = 1 << 14

MANIFEST = "level int, place int, name string, buckets int"
KEY = ["a", "b"]


def line_key(line: Column) -> Column:
    """The line with all white space stripped at both ends and only A-Z lower-cased."""
    edge = list(SPACE_CHARS)

    def stripped(x: Column) -> Column:
        return F.when(
            F.left(x, F.lit(1)).isin(edge) | F.right(x, F.lit(1)).isin(edge),
            F.regexp_replace(x, rf"^{SPACE}+|{SPACE}+\z", ""),
        ).otherwise(x)

    def lowered(x: Column) -> Column:
        # lower() is the faster way where all characters are ASCII
        other = F.translate(x, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(other)

    return let(stripped(line), lowered)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key: which text it is in, where, its key's hash, and whether its first there.

    ``row`` tells rows apart even if they are equal; ``doc_id``, ``ta`` and ``tb`` find the text again.
    """
    named = docs.select("doc_id", text_of("text").alias("_t"))
    keyed = named.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        text_key(F.col("_t")).alias("_k"),
        F.transform(F.split("_t", "\n"), lambda x, i: F.struct(line_key(x).alias("key"), i.alias("pos"))).alias("_l"),
    )

    def marked(ordered: Column) -> Column:
        return F.transform(
            ordered,
            lambda x, i: F.struct(
                x["pos"].alias("pos"),
                text_key(x["key"]).alias("h"),
                F.coalesce(x["key"] != F.get(ordered, i - 1)["key"], F.lit(True)).alias("first"),
            ),
        )

    long_enough = F.filter("_l", lambda x: F.char_length(x["key"]) >= min_chars)
    return keyed.select(
        "row", "doc_id", F.col("_k.a").alias("ta"), F.col("_k.b").alias("tb"), F.inline(let(F.sort_array(long_enough), marked))
    ).select("row", "doc_id", "ta", "tb", "pos", "first", F.col("h.a").alias("a"), F.col("h.b").alias("b"))


@dataclass
class LineRuns:
    """The runs of one folder. ``levels`` lists the run folders of each level, ``shared`` those of shared keys.

    Every change ends with a new version of the manifest, a table of a few rows, so a job that dies
    leaves the version before it; runs that no version names are never read.
    """

    spark: SparkSession
    folder: str
    min_documents: int = MIN_DOCUMENTS
    fanout: int = FANOUT
    buckets: int = 0
    levels: dict[int, list[str]] = field(default_factory=dict)
    shared: list[str] = field(default_factory=list)
    version: int = 0

    def __post_init__(self) -> None:
        # the partitions of a counted batch, so that these are buckets as they come
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def load(cls, spark: SparkSession, folder: str, **options) -> LineRuns:
        """The runs as the last complete change left them, or none if there never was one.

        A version whose write did not end is passed over; one that ended and cannot be read is an error.
        """
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
        system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        names = [s.getPath() for s in system.listStatus(path)] if system.exists(path) else []
        ended = [p for p in names if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        if not ended:
            return cls(spark, folder, **options)
        version = max(int(p.getName().removeprefix("v=")) for p in ended)
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest/v={version}").collect()  # a row per run
        if not rows:
            raise ValueError(f"version {version} of the manifest in {folder} is empty")
        runs = cls(spark, folder, **{**options, "buckets": rows[0].buckets})
        runs.version = version
        for r in sorted((r for r in rows if r.name is not None), key=lambda r: r.place):
            (runs.shared if r.level < 0 else runs.levels.setdefault(r.level, [])).append(r.name)
        return runs

    def _save(self) -> None:
        self.version += 1
        named = [(lv, i, n, self.buckets) for lv, names in [(-1, self.shared), *self.levels.items()] for i, n in enumerate(names)]
        rows = self.spark.createDataFrame(named or [(0, 0, None, self.buckets)], MANIFEST).coalesce(1)
        rows.write.parquet(f"{self.folder}/manifest/v={self.version}")

    def _read(self, names: list[str]) -> DataFrame:
        """Folders as the partitions of one table whose buckets the planner knows: rows of a key are in one bucket of all."""
        if not names:
            return self.spark.createDataFrame([], "a long, b long, n long")
        table = f"line_runs_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} (a BIGINT, b BIGINT, n BIGINT, run STRING) USING parquet PARTITIONED BY (run) "
            f"CLUSTERED BY (a, b) SORTED BY (a, b) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{table}'"
        )
        parts = " ".join(f"PARTITION (run = '{name}') LOCATION '{self.folder}/{name}'" for name in names)
        self.spark.sql(f"ALTER TABLE {table} ADD {parts}")
        return self.spark.table(table).drop("run")

    def _held(self, names: list[str]) -> DataFrame:
        """The counts of some runs, added up. Keys that became shared with their batch have theirs below zero."""
        return self._read(names).where("n > 0").groupBy(*KEY).agg(F.sum("n").alias("n"))

    def _shared(self) -> DataFrame:
        return self._read(self.shared).where("n < 0").select(*KEY)

    def _write(self, df: DataFrame) -> str:
        name = f"run-{uuid.uuid4().hex}"
        made = df.select("a", "b", F.col("n").cast("long").alias("n"))
        table = f"line_run_{uuid.uuid4().hex}"
        made.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # the files stay: the table is external
        return name

    def counted(self, lines: DataFrame) -> DataFrame:
        """Documents of a batch per key that is not known to be shared, and with those of all runs as ``total``."""
        found = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        if self.shared:
            found = found.join(self._shared(), KEY, "left_anti")
        names = [name for level in self.levels.values() for name in level]
        if not names:
            return found.withColumn("total", F.col("n"))
        held = self._held(names).withColumnRenamed("n", "held")
        return found.join(held, KEY, "left").select(*KEY, "n", (F.col("n") + F.coalesce("held", F.lit(0).cast("long"))).alias("total"))

    def add(self, lines: DataFrame) -> None:
        """Count one batch, given as ``a`` and ``b`` of each key of each document, against the runs and as a new run."""
        reached = F.col("total") >= self.min_documents
        name = self._write(self.counted(lines).withColumn("n", F.when(reached, -F.col("n")).otherwise(F.col("n"))))
        self.shared.append(name)
        self.levels.setdefault(0, []).append(name)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            one = self._write(self._held(self.levels[level]))
            self.levels[level] = []
            self.levels.setdefault(level + 1, []).append(one)
            level += 1
        if len(self.shared) > 2 * self.fanout:  # no key is in two of them
            self.shared = [self._write(self._shared().withColumn("n", F.lit(-1)))]
        self._save()

    def shared_keys(self) -> DataFrame:
        """Keys found in at least ``min_documents`` documents of all batches."""
        return self._shared()


def drop_lines(docs: DataFrame, lines: DataFrame, shared: DataFrame) -> DataFrame:
    """``docs`` with ``_lines`` and ``_kept``: all lines of the text, and the numbers of those that stay.

    The lines to drop are found by key and brought to their text by its doc_id and hash, so the texts are
    shuffled once and equal rows share an answer.
    """
    dropped = (
        lines.join(shared, KEY, "left_semi")
        .groupBy(F.col("doc_id").alias("_id"), F.col("ta").alias("_ta"), F.col("tb").alias("_tb"))
        .agg(F.collect_set("pos").alias("_dropped"))
    )
    text = text_of(docs["text"])
    keyed = docs.withColumn("_k", text_key(text))
    same = keyed["doc_id"].eqNullSafe(dropped["_id"]) & (keyed["_k.a"] == dropped["_ta"]) & (keyed["_k.b"] == dropped["_tb"])
    joined = keyed.join(dropped, same, "left").withColumn("_lines", F.split(text, "\n"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.when(F.col("_dropped").isNull(), every).otherwise(F.array_except(every, F.col("_dropped")))
    return joined.withColumn("_kept", kept).drop("_k", "_id", "_ta", "_tb", "_dropped")


def kept_text() -> Column:
    return F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")


def batch_shares(documents: int, first: int = FIRST_BATCH) -> list[float]:
    """Where batches end, as shares of all documents, if each is twice as large as the one before."""
    ends, size, total = [], first, 0
    while total < documents:
        total += size
        ends.append(total)
        size *= 2
    return [min(1.0, e / documents) for e in ends]


def shared_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, first: int = FIRST_BATCH) -> tuple[DataFrame, DataFrame]:
    """The hashed lines of all documents and the shared keys, found by adding the documents in batches.

    A document's batch is by a hash of its row, and lines are kept by batch, so that each batch reads its own alone.
    """
    spark = docs.sparkSession
    ends = batch_shares(docs.count(), first)
    place = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    batch = F.coalesce(*[F.when(place < e, i) for i, e in enumerate(ends[:-1])], F.lit(max(0, len(ends) - 1)))
    folder = shared_folder(spark, "hashed-lines")
    hashed = hashed_lines(docs, min_chars).withColumn("batch", batch)
    hashed.write.option("compression", "zstd").partitionBy("batch").parquet(folder)
    lines = spark.read.schema(hashed.schema).parquet(folder)
    runs = LineRuns(spark, shared_folder(spark, "line-runs"), min_documents)
    for i in range(len(ends)):
        runs.add(lines.where((F.col("batch") == i) & F.col("first")))
    return lines, runs.shared_keys()


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with shared lines taken out of ``text`` and ``n_chars`` counted anew; all rows stay.

    Keys of at least ``min_chars`` code points found in at least ``min_documents`` rows lose their lines
    everywhere. A null text is one empty line, which has no key, so the text becomes empty. Other
    columns pass unchanged, whatever their names.
    """
    docs, restored = sheltered(docs, "doc_id", "text", "n_chars")
    lines, shared = shared_lines(docs, min_documents, min_chars)
    cleaned = drop_lines(docs, lines, shared).withColumn("text", kept_text())
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast("long"))
    return restored(cleaned)


def dedup_digest(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: doc_id, lines before dropping, lines dropped, and the SHA-256 of what stays."""
    docs = sheltered(docs, "doc_id", "text")[0].select("doc_id", "text")
    lines, shared = shared_lines(docs, min_documents, min_chars)
    return drop_lines(docs, lines, shared).select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )


ORACLE_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT row_id, doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM docs),
keyed AS (SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+\z', '', 'g'),
                              '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
shared AS (SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT row_id) >= {MIN_DOCUMENTS})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE s.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared AS s ON keyed.key = s.key
GROUP BY row_id, doc_id
"""
