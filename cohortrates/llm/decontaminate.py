"""Training passages that copy benchmark items: rare n-gram seeds, then Smith-Waterman alignment.

Words are case-folded letter and digit runs. A seed is three words of an item, next to each other or with one
word left out between them, so that a copy with every third word replaced still has some. Seeds that many
items have are no use to tell them apart: they are left out, and an item that has hardly any other gets them
lengthened by the words that follow, until few items share them. Of the rest an item uses the rarer ones by
their count in all passages. A pair of passage and item needs a share of the item's seeds before the words of both are
brought together, and enough common words before they are aligned. Alignment is local and by words, so edits, insertions
and gaps cost, but do not hide, a copy.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, sheltered, text_key, text_of

#: Words of a seed, and where they stand, by their distance from its first.
NGRAM = 3
SEEDS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
MATCH, MISMATCH, GAP = 2, -1, -1

#: Share of the score of a verbatim copy from which a passage counts as a copy of the item.
SIMILARITY = 0.5

#: A seed of more items than this tells them apart badly. So a seed makes at most so many pairs per passage.
COMMON = 64

#: An item of which less than this share of its seeds is not common has its common ones lengthened, to these numbers of words.
FEW, RUNS = 0.5, (6, 12, 24, 48, 96, 192)

#: The share of an item's seeds that is used, the rarest ones, and the share of these that a passage must hold.
RARE, SHARED = 0.75, 1 / 32

#: Bits of the maps that tell which words and seeds any item has: fixed powers of two, so their size is.
WORD_BITS, GRAM_BITS = 1 << 22, 1 << 24

#: Classes of item length, each with a map of its own: up to so many words, and any number.
CLASSES = (16, 64, 256)

#: Words a task remembers the hashes of.
KNOWN = 300_000

WORD = re.compile(r"[^\W_]+")

#: Odd multipliers that mix the word hashes of a seed.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.casefold())


def word_hash(word: str) -> int:
    data = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) | zlib.crc32(data, 0x5BD1E995) << 32 or 1


def _mixed(mixed: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (mixed * MIX[0] ^ word) * MIX[1]
    return mixed ^ mixed >> np.uint64(29)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words; none where there are fewer."""
    mixed = hashes[: max(0, len(hashes) - n + 1)].copy()
    for k in range(1, n):
        mixed = _mixed(mixed, hashes[k : len(mixed) + k])
    return mixed


def shapes(n: int) -> tuple[tuple[int, ...], ...]:
    """The shapes of the seeds of an item of ``n`` words; fewer than three are one seed."""
    return tuple(s for s in SEEDS if s[-1] < n) or (tuple(range(n)),)


def seed_hashes(hashes: np.ndarray, shape: tuple[int, ...], places: np.ndarray | None = None) -> np.ndarray:
    """The hashes of the seeds of a shape that begin at ``places``, or everywhere."""
    if places is None:
        places = np.arange(max(0, len(hashes) - shape[-1]))
    mixed = hashes[places] ^ np.uint64(len(shape) * 64 + sum(shape))
    for k in shape[1:]:
        mixed = _mixed(mixed, hashes[places + k])
    return mixed


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment's score, and where it begins and ends in the passage.

    Row by row over the item's words; the gap along a row is a running maximum.
    """
    m = len(passage)
    steps = np.arange(m, dtype=np.int64) * -GAP
    score, begin = np.zeros(m + 1, dtype=np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        made = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        source = begin[:-1].copy()
        down = score[1:] + GAP
        source = np.where(down > made, begin[1:], source)
        made = np.maximum(made, down)
        fresh = made <= 0
        made[fresh], source[fresh] = 0, np.arange(1, m + 1)[fresh]
        reach = np.maximum.accumulate(made + steps)
        along = reach - steps
        # where a gap along the row wins, the start is that of the last place that set the maximum
        setter = np.maximum.accumulate(np.where(made + steps == reach, np.arange(m), 0))
        score = np.concatenate([[0], along])
        begin = np.concatenate([[0], source[setter]])
        top = int(along.argmax())
        if along[top] > best[0]:
            best = (int(along[top]), int(begin[top + 1]), top + 1)
    return best


def _bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of the bits any value falls on. What reaches the driver is bounded by their number."""
    found = values.select(F.pmod(F.col(column), F.lit(bits)).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()
    marks = np.zeros(bits // 8, dtype=np.uint8)
    np.bitwise_or.at(marks, found >> 3, (1 << (found & 7)).astype(np.uint8))
    return marks


def _marked(marks: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    places = (hashes & np.uint64(bits - 1)).astype(np.int64)
    return (marks[places >> 3] >> (places & 7)) & 1 == 1


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """A column of lists of unsigned numbers, as signed ones."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, dtype=np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def item_words(items: DataFrame) -> DataFrame:
    """item_id, its word hashes, and ``a``, ``b``, the key of its words in order. Items without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.array([word_hash(w) for w in words_of(t.as_py())], dtype=np.uint64) for t in batch.column(1)]
            words = pa.array([h.view(np.int64).tolist() for h in hashes], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), words], ["item_id", "words"])

    kind = items.schema["item_id"].dataType.simpleString()
    made = items.select("item_id", text_of("text").alias("text")).mapInArrow(run, f"item_id {kind}, words array<long>")
    return made.where("size(words) > 0").select("*", F.xxhash64("words").alias("a"), F.xxhash64(F.lit("second"), "words").alias("b"))


def unit_seeds(units: DataFrame) -> DataFrame:
    """``unit``, ``gram`` and ``at``: the seeds of each distinct item, once each, with their first place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple[int, np.ndarray, np.ndarray]] = []
            for unit, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = words.values.to_numpy().view(np.uint64)
                grams = [seed_hashes(hashes, shape) for shape in shapes(len(hashes))]
                first, at = np.unique(np.concatenate(grams), return_index=True)
                places = np.concatenate([np.arange(len(g)) for g in grams])[at]
                made.append((unit, first.view(np.int64), places))
            columns = [
                pa.array(np.concatenate([np.full(len(g), u) for u, g, _ in made] or [[]]).astype(np.int64)),
                pa.array(np.concatenate([g for _, g, _ in made] or [[]]).astype(np.int64)),
                pa.array(np.concatenate([p for _, _, p in made] or [[]]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "gram", "at"])

    return units.select("unit", "words").mapInArrow(run, "unit long, gram long, at long")


def _reach(words: int, similarity: float) -> int:
    """Words that a copy of an item of ``words`` words can take up: errors cost it at most 2n(1 - similarity) words more."""
    return math.ceil(words * (1 + MATCH * max(0.0, 1 - similarity)))


def passages(docs: DataFrame, units: DataFrame, seeds: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The parts of texts around seeds, as far as a copy of an item of that length can reach.

    One row per passage: doc_id, ``t`` (tells texts of one id apart), ``at`` (its first word's number), its
    word hashes, 0 for words of no item, and its seeds that some item has. The maps may let others through; the
    join does not.
    """
    lengths = units.agg(F.max("n"), F.min("n")).first()
    longest, shortest = lengths[0] or 0, lengths[1] or 3
    bounds = [c for c in CLASSES if c < longest] + [longest]
    of_class = F.coalesce(*[F.when(F.col("n") <= c, i) for i, c in enumerate(bounds)], F.lit(0))
    classed = seeds.join(units.select("unit", of_class.alias("class")), "unit")
    word_bytes = _bitmap(units.select(F.explode("words").alias("h")), "h", WORD_BITS).tobytes()
    maps = [(_reach(c, similarity), _bitmap(classed.where(F.col("class") == i), "gram", GRAM_BITS)) for i, c in enumerate(bounds)]
    forms = dict.fromkeys((*(tuple(range(n)) for n in range(shortest, NGRAM)), *SEEDS))

    class Known(dict):
        """Hashes of words, 0 for those of no item."""

        def __missing__(self, word: str) -> int:
            if len(self) >= KNOWN:
                self.clear()
            h = word_hash(word)
            bit = h & (WORD_BITS - 1)
            self[word] = h = h if word_bytes[bit >> 3] >> (bit & 7) & 1 else 0
            return h

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            out: dict[str, list] = {"row": [], "at": [], "words": [], "grams": []}  # the last two: an array a passage
            for row, text in enumerate(batch.column(2)):
                split = words_of(text.as_py())
                hashes = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
                there = hashes != 0
                grams_at, reach_at, spans = [], [], []
                for form in forms:
                    if len(split) <= form[-1]:
                        continue
                    full = there[: len(there) - form[-1]].copy()
                    for k in form[1:]:
                        full &= there[k : k + len(full)]
                    places = np.flatnonzero(full)
                    grams = seed_hashes(hashes, form, places)
                    reach = np.zeros(len(places), dtype=np.int64)
                    for words, marks in maps:
                        reach[_marked(marks, grams, GRAM_BITS)] = words
                    hit = np.flatnonzero(reach)
                    grams_at.append(grams[hit])
                    reach_at.append(reach[hit])
                    spans.append(places[hit])
                if not sum(map(len, spans)):
                    continue
                spots, grams, reach = np.concatenate(spans), np.concatenate(grams_at), np.concatenate(reach_at)
                lows, highs = np.maximum(spots - reach, 0), np.minimum(spots + 4 + reach, len(split))
                order = np.argsort(lows, kind="stable")
                ends = np.maximum.accumulate(highs[order])
                cuts = np.flatnonzero(lows[order][1:] > ends[:-1]) + 1
                for part in np.split(order, cuts):
                    low, high = int(lows[part].min()), int(highs[part].max())
                    out["row"].append(row)
                    out["at"].append(low)
                    out["words"].append(hashes[low:high])
                    out["grams"].append(np.unique(grams[part]))
            rows = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(out["at"], pa.int64()), _lists(out["words"]), _lists(out["grams"])],
                ["doc_id", "t", "at", "words", "grams"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", text_key(text_of("text"))["a"].alias("t"), text_of("text").alias("text"))
    return named.mapInArrow(run, f"doc_id {kind}, t long, at long, words array<long>, grams array<long>")


def _runs(rows: DataFrame, name: str, sizes: list[int]) -> DataFrame:
    """``name``, ``size``, ``at`` and ``run``: a hash of every run of the sizes of words in the array ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = words.values.to_numpy().view(np.uint64)
                for size in sizes:
                    if len(made := gram_hashes(hashes, size)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(made), key)), pa.array(np.full(len(made), size)), pa.array(np.arange(len(made))), pa.array(made.view(np.int64))],
                            [name, "size", "at", "run"],
                        )

    return rows.select(name, "words").mapInArrow(run, f"{name} long, size long, at long, run long")


def lengthened(units: DataFrame, seeds: DataFrame, common: int = COMMON, few: float = FEW) -> DataFrame:
    """``unit``, ``size`` and ``run``: at each common seed of items with few others, the shortest run that is not common.

    An item that ends before such a run is found has its last words, or all of them, as the run.
    """
    counted = seeds.withColumn("items", F.col("items") > common)
    poor = counted.groupBy("unit").agg(F.avg(F.col("items").cast("int")).alias("share")).where(F.col("share") > 1 - few)
    held = units.join(poor, "unit", "left_semi")
    sizes = sorted(set(RUNS))
    whole = held.where(F.col("n") <= max(sizes)).groupBy("n").agg(F.count(F.lit(1))).collect()  # a row per length up to the longest run
    runs = settled(_runs(held, "unit", sorted({*sizes, *(r.n for r in whole)})), "benchmark-runs")
    rare = runs.groupBy("size", "run").agg(F.countDistinct("unit").alias("n")).where(F.col("n") <= common).drop("n")
    starts = counted.where("items").select("unit", "at").distinct()
    fitting = runs.join(rare, ["size", "run"], "left_semi").join(starts.withColumnRenamed("at", "begin"), "unit")
    # the run begins at the seed, or is as near to it as the end of the item lets it
    fits = F.col("at") <= F.col("begin")
    order = Window.partitionBy("unit", "begin").orderBy("size", F.col("at").desc())
    return fitting.where(fits).withColumn("place", F.row_number().over(order)).where("place = 1").select("unit", "size", "run").distinct()


def candidates(found: DataFrame, units: DataFrame, seeds: DataFrame, common: int = COMMON) -> DataFrame:
    """Pairs of ``passage`` and ``unit`` that share enough rare seeds, or a run of words.

    ``seeds`` have the number of ``items`` that share them. Pairs per passage and seed are bounded by ``common``.
    """
    hits = found.select("passage", F.explode("grams").alias("gram"))
    apart = seeds.where(F.col("items") <= common).select("unit", "gram")
    occurs = hits.join(apart.select("gram").distinct(), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("passages"))
    by_rarity = Window.partitionBy("unit").orderBy("passages", "gram")
    ranked = apart.join(occurs, "gram").withColumn("place", F.row_number().over(by_rarity))
    sizes = apart.groupBy("unit").agg(F.count(F.lit(1)).alias("seeds"))
    rare = ranked.join(sizes, "unit").where(F.col("place") <= F.ceil(F.col("seeds") * RARE))
    need = F.greatest(F.lit(1), F.floor(F.col("seeds") * SHARED))
    shared = hits.join(rare.select("gram", "unit", need.alias("need")), "gram").groupBy("passage", "unit").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
    pairs = shared.where("n >= need").select("passage", "unit")
    longer = settled(lengthened(units, seeds, common), "benchmark-long-seeds")
    used = sorted(r["size"] for r in longer.select("size").distinct().collect())  # lengths of items, RUNS at most and up to the last of them
    if used:
        pairs = pairs.union(_runs(found, "passage", used).join(longer, ["size", "run"]).select("passage", "unit")).distinct()
    return pairs


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per text and item that it holds a copy of: doc_id, ``t``, item_id, score, similarity, first_word, n_words.

    Similarity is the alignment's score as a share of a verbatim copy's. Texts and items without words
    match nothing; null ids are ids like any other; equal rows share one answer, as do items of the same words.
    Words are numbered from 0.
    """
    docs, items = sheltered(docs, "doc_id", "text")[0], sheltered(items, "item_id", "text")[0]
    own = settled(item_words(items), "benchmark-words")
    distinct = own.groupBy("a", "b").agg(F.first("words").alias("words"))
    units = settled(distinct.select(F.monotonically_increasing_id().alias("unit"), "a", "b", "words", F.size("words").alias("n")), "benchmark-units")
    grams = settled(unit_seeds(units), "benchmark-seeds")
    shares = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("items"))
    seeds = settled(grams.join(shares, "gram"), "benchmark-seed-counts")
    found = settled(passages(docs, units, seeds, similarity).withColumn("passage", F.monotonically_increasing_id()), "passages")
    pairs = (
        candidates(found, units, seeds)
        .join(found.drop("grams"), "passage")
        .join(units.select("unit", F.col("words").alias("item_words")), "unit")
        .select("doc_id", "t", "at", "unit", "words", "item_words")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, aligned = [], []
            for i in range(batch.num_rows):
                passage, item = batch.column(4)[i].values.to_numpy(), batch.column(5)[i].values.to_numpy()
                # no alignment has more matches than the item has words of the passage
                if np.isin(item, passage).sum() / len(item) < similarity:
                    continue
                results.append((*align(passage, item), len(item)))
                aligned.append(i)
            score, begin, end, n = (np.array(c, dtype=np.int64) for c in (zip(*results, strict=True) if results else ([], [], [], [])))
            share = score / (MATCH * np.maximum(n, 1))
            keep = pa.array(np.flatnonzero(share >= similarity))
            held = batch.take(pa.array(aligned, pa.int64()))
            first = held.column(2).to_numpy() + begin
            columns = [held.column(0), held.column(1), held.column(3), pa.array(score), pa.array(share), pa.array(first), pa.array(end - begin)]
            yield pa.RecordBatch.from_arrays([c.take(keep) for c in columns], ["doc_id", "t", "unit", "score", "similarity", "first_word", "n_words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, t long, unit long, score long, similarity double, first_word long, n_words long"
    best = F.max(F.struct("similarity", "score", (-F.col("first_word")).alias("first"), "n_words")).alias("best")
    named = own.select("item_id", "a", "b").join(units.select("unit", "a", "b"), ["a", "b"]).select("unit", "item_id").distinct()
    return (
        pairs.mapInArrow(run, schema)
        .groupBy("doc_id", "t", "unit")
        .agg(best)
        .join(named, "unit")
        .select("doc_id", "t", "item_id", "best.score", "best.similarity", (-F.col("best.first")).alias("first_word"), "best.n_words")
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item, with all their columns."""
    docs, restored = sheltered(docs, "doc_id", "text")
    found = settled(contaminated(docs, items, similarity), "contaminated").select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"))
    keyed = docs.withColumn("_k", text_key(text_of(docs["text"]))["a"])
    same = keyed["doc_id"].eqNullSafe(found["_id"]) & (keyed["_k"] == found["_t"])
    return restored(keyed.join(found, same, "left_anti"))
