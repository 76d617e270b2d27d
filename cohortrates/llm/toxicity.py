"""Document toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, of its pairs of neighbouring words and of its pairs of words one or two
words apart, each hashed to a bucket. Every bucket has a learning rate of its own, from its own sum of squared
gradients, and an L1 penalty that keeps its weight at zero until its evidence exceeds it. So the weights
are a short list of buckets, small enough to go to every task whatever the size of the corpus.

Learning runs in rounds. The training rows are dealt to shards; in a round each shard learns from its rows,
beginning with the common state, and the changes of a bucket are averaged over the shards that touched it.
Scoring reads every text once and moves none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, sheltered, text_key, text_of

#: A score from which a document counts as toxic.
THRESHOLD = 0.3

#: Labelled ids that are learnt from, those of the smallest hashes; what is broadcast to find their texts.
MAX_LABELS = 1 << 14

#: Training rows of a shard, about, and times that each shard goes over its rows from the common state.
SHARD, ROUNDS = 2048, 6

#: Buckets for words, for pairs of neighbours, and for pairs with one and with two words between.
WORD_BUCKETS, PAIR_BUCKETS, SKIP_BUCKETS = 1 << 18, 1 << 17, 1 << 17
SKIPS = (2, 3)
BIAS = WORD_BUCKETS + PAIR_BUCKETS + SKIP_BUCKETS
BUCKETS = BIAS + 1

WORD = re.compile(r"[^\W_]+")

#: Odd multipliers that mix the hashes of a pair.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

#: Words a task remembers the hashes of.
KNOWN = 300_000


class Buckets:
    """The buckets of texts. Remembers the hashes of words, as many as KNOWN."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        if len(self.known) >= KNOWN:
            self.known.clear()
        made = self.known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return made

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """The buckets of words, pairs and skip-grams, with repeats; at the end the one every text has."""
        get, of = self.known.get, self._hash
        words = np.array([h if (h := get(w)) is not None else of(w) for w in WORD.findall(text.casefold())], dtype=np.uint64)
        yield (words % np.uint64(WORD_BUCKETS)).astype(np.int32)
        for apart in (1, *SKIPS):
            if len(words) <= apart:
                continue
            with np.errstate(over="ignore"):
                mixed = (words[:-apart] * MIX[0] ^ words[apart:]) * MIX[1]
            mixed ^= mixed >> np.uint64(29)
            low, size = (WORD_BUCKETS, PAIR_BUCKETS) if apart == 1 else (WORD_BUCKETS + PAIR_BUCKETS, SKIP_BUCKETS)
            yield (mixed % np.uint64(size)).astype(np.int32) + np.int32(low)
        yield np.array([BIAS], dtype=np.int32)

    def of(self, text: str) -> np.ndarray:
        return np.unique(np.concatenate(list(self.parts(text))))


@dataclass(frozen=True)
class Rates:
    """Step size ``alpha / (beta + sqrt(sum of squared gradients))`` of a bucket, and the penalties."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weights of buckets of state z, n: zero where L1 outweighs what has been seen."""
        held = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, held / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))


def learn(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, int]], rates: Rates) -> None:
    """One pass of FTRL-proximal over (distinct buckets, label), changing the state in place."""
    for buckets, label in rows:
        own_z, own_n = z[buckets], n[buckets]
        weights = rates.weights(own_z, own_n)
        gradient = _probability(weights.sum()) - label
        grown = own_n + gradient * gradient
        z[buckets] = own_z + gradient - (np.sqrt(grown) - np.sqrt(own_n)) / rates.alpha * weights
        n[buckets] = grown


def _probability(total: float) -> float:
    return 1.0 / (1.0 + math.exp(-min(max(total, -500.0), 500.0)))


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id's text leaves 2 when divided by 4; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Texts that are learnt from, with their label: ``a``, ``b`` (the text's key), ``text`` and ``toxic``.

    Labels of held-out ids, and null ones, are never read. Of the rest, ``max_labels`` ids are taken by hash.
    An id labelled both ways is two labels. Equal texts of one label are one row, however often they occur.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    # a bounded table: at most max_labels rows of two numbers, whatever the number of labels
    chosen = settled(known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labels), "toxic-labels")
    texts = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    keyed = texts.select(text_key(F.col("text")).alias("k"), "text", "toxic")
    return keyed.groupBy("k.a", "k.b", "toxic").agg(F.first("text").alias("text"))


def shards(rows: DataFrame, size: int = SHARD) -> DataFrame:
    """One row per shard, with the buckets of all its texts end to end, their numbers and their labels.

    Rows go to shards by the hash of their text, and are in order of it, so a shard is the same in every run.
    """
    rows = settled(rows, "toxic-texts")
    n = max(1, math.ceil(rows.count() / size))

    def gathered(group: pa.Table) -> pa.Table:
        made = Buckets()
        ordered = group.sort_by([("a", "ascending"), ("b", "ascending"), ("toxic", "ascending")])
        sets = [made.of(t.as_py()) for t in ordered.column("text")]
        lists = [
            np.concatenate(sets).astype(np.int32),
            np.array([len(s) for s in sets], dtype=np.int32),
            ordered.column("toxic").to_numpy().astype(np.int32),
        ]
        return pa.table([pa.array([x.tobytes()], pa.binary()) for x in lists], ["buckets", "sizes", "labels"])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("a", "b"), F.lit(n)))
    return dealt.groupBy("shard").applyInArrow(gathered, "buckets binary, sizes binary, labels binary")


def fit(docs: DataFrame, labels: DataFrame, rates: Rates | None = None, max_labels: int = MAX_LABELS, shard: int = SHARD, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The weights that are not zero: their ``buckets`` and ``weights``.

    The state is two numbers a bucket, of which there are BUCKETS at most; that is what reaches the driver.
    Without training rows there are no weights, and every score is a half.
    """
    rates = rates or Rates()
    labels = sheltered(labels, "doc_id", "toxic")[0]
    docs = sheltered(docs, "doc_id", "text")[0]
    held = settled(shards(training_rows(docs, labels, max_labels), shard), "toxic-shards")
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    context = docs.sparkSession.sparkContext
    for _ in range(rounds):
        state = context.broadcast((z, n))

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    buckets, sizes, marks = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int32) for c in range(3))
                    begin_z, begin_n = state.value
                    own_z, own_n = begin_z.copy(), begin_n.copy()
                    learn(own_z, own_n, list(zip(np.split(buckets, sizes.cumsum()[:-1]), marks.tolist(), strict=True)), rates)
                    changed = np.flatnonzero(own_n != begin_n)
                    columns = [pa.array(changed.astype(np.int32)), pa.array((own_z - begin_z)[changed]), pa.array((own_n - begin_n)[changed])]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "z", "n"])

        changes = held.mapInArrow(run, "bucket int, z double, n double").groupBy("bucket")
        # sums in whole numbers do not depend on the order of tasks
        fixed = [F.sum(F.round(F.col(c) * 2.0**32).cast("long")).alias(c) for c in ("z", "n")]
        found = changes.agg(F.count(F.lit(1)).alias("shards"), *fixed).toArrow()
        place, scale = found["bucket"].to_numpy(), found["shards"].to_numpy() * 2.0**32
        z[place] += found["z"].to_numpy() / scale
        n[place] += found["n"].to_numpy() / scale
        state.unpersist()
    weights = rates.weights(z, n).astype(np.float32)
    kept = np.flatnonzero(weights).astype(np.int32)
    return {"buckets": kept, "weights": weights[kept]}


def scored(docs: DataFrame, model: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, which must not have ``score`` among them, and the score of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS, dtype=np.float32)
        weights[model["buckets"]] = model["weights"]
        made = Buckets()

        def score(text: str) -> float:
            heavy = [part[weights[part] != 0] for part in made.parts(text)]  # the others need not be told apart
            return _probability(weights[np.unique(np.concatenate(heavy))].sum(dtype=np.float64))

        for batch in batches:
            scores = pa.array([score(t.as_py()) for t in batch.column(batch.num_columns - 1)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], [*keep, "score"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "score double"])
    return docs.select(*[F.col(f"`{c}`") for c in keep], text_of("text").alias("_text")).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted (1 from ``threshold`` on).

    Only doc_id and text are read, whatever other columns are called; of labels, doc_id and toxic. A null or
    empty text has the score of no words. Equal rows get equal scores; an empty table gives none.
    """
    docs = sheltered(docs, "doc_id", "text")[0]
    made = scored(docs, fit(docs, labels), ["doc_id"])
    shown = made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
    return shown.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
