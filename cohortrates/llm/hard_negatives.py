"""Hard negatives by score windows, over Hilbert-ordered blocks with zone maps.

Vectors become whole numbers and are stored in blocks of one label each, in the order of a Hilbert curve through
their leading axes. A block's zone map has the least and greatest value of every component. Interval arithmetic
on it bounds the inner product of an anchor with any row of the block, so a block is read only if its bounds meet a
window of some anchor: for positives, scores from the best known fifth up; for negatives of a positive, from half
of its score to 95 hundredths, and from the best known third up.

Anchors are a stated query set, taken chunk by chunk. A chunk goes to every task, is bounded in rows, and a task
keeps the best few of its blocks for each anchor, so no vector is ever shuffled after the blocks are made.
All scores are exact whole numbers, and a tie never prunes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, sheltered

#: Anchors are the rows whose id this divides; positives per anchor, and negatives per positive.
EVERY, POSITIVES, NEGATIVES = 50, 5, 3

#: A negative's score as hundredths of its positive's.
LEAST, MOST = 50, 95

#: A component x is stored as floor(SCALE * x), and no further from zero than LIMIT.
SCALE, LIMIT = 256, 1 << 25

#: Rows of a block, blocks read first to learn what is already known to be reached, and anchors of a chunk.
BLOCK, FIRST_BLOCKS, CHUNK = 512, 16, 1 << 14

#: Vectors that the axes of the curve are found from, axes, and bits per axis.
SAMPLE, AXES, BITS = 4096, 8, 6

#: Cells that say which blocks are read, and ranges they are put together to.
CELLS, RANGES = 4096, 100

LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that take part: none of them null, nor any component null or not finite."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    named = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)
    return named.select(F.col("vec_id").cast("long").alias("id"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def whole_numbers(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """The vectors times SCALE, rounded down, as rows; shorter ones are filled up with zeros."""
    made = np.zeros((len(vectors), width), dtype=np.int32)
    for i, v in enumerate(vectors):
        made[i, : len(v)] = np.clip(np.floor(SCALE * v), -LIMIT, LIMIT)
    return made


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve of each row of cells, one column per axis of ``bits`` bits."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):  # undo the turns of the smaller cubes, from the largest down
        q = one << np.uint64(level)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & (q - one))
            x[0] ^= np.where(high, q - one, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        flip ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    place = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << one | x[i] >> np.uint64(level) & one
    return place.astype(np.int64)


@dataclass(frozen=True)
class Curve:
    """Axes through the vectors, and the borders of 2 ** BITS cells on each."""

    mean: np.ndarray
    axes: np.ndarray
    borders: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray) -> Curve:
        """Leading principal axes of a sample, each cut to cells that hold as many of it."""
        mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
        axes = np.linalg.svd(sample - mean, full_matrices=False)[2][:AXES].T if sample.size else np.zeros((sample.shape[1], 1))
        shares = np.arange(1, 1 << BITS) / (1 << BITS)
        borders = np.quantile((sample - mean) @ axes, shares, axis=0).T if sample.size else np.zeros((1, len(shares)))
        return cls(mean, axes, borders)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        along = (vectors - self.mean) @ self.axes
        return hilbert(np.stack([np.searchsorted(b, along[:, i]) for i, b in enumerate(self.borders)], axis=1), BITS)


def build_blocks(rows: DataFrame, width: int, every: int = EVERY, size: int = BLOCK) -> DataFrame:
    """The blocks of the usable rows, in order: ``block`` (its number within the task, after the task's), ``label``,
    ``n_anchors``, the zone map ``low`` and ``high``, and ``ids`` in ascending order with their ``vectors``.

    Equal rows are one. They meet in one task only after each batch has dropped its own.
    """
    labels = rows.schema["label"].dataType.simpleString()
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    curve = Curve.of(whole_numbers([np.array(r.v) for r in picked], width).astype(float))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = whole_numbers([v.values.to_numpy() for v in batch.column(2)], width)
            ids = batch.column(0).to_numpy()
            first = np.arange(len(ids))
            if len(np.unique(ids)) < len(ids):
                seen = {(i, y, v.tobytes()): n for n, (i, y, v) in reversed(list(enumerate(zip(ids.tolist(), batch.column(1).to_pylist(), made, strict=True))))}
                first = np.array(sorted(seen.values()), dtype=np.int64)
            own = batch.take(pa.array(first))
            made = made[first]
            vectors = pa.array([v.tobytes() for v in made], pa.binary())
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(curve.places(made)), vectors], ["id", "label", "place", "v"])

    ordered = ["label", "place", "id", "v"]
    along = rows.mapInArrow(placed, f"id long, label {labels}, place long, v binary")

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        label, before, ids, vectors = None, None, [], []

        def made() -> pa.RecordBatch:
            nonlocal number
            order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
            matrix = np.frombuffer(b"".join(vectors), dtype=np.int32).reshape(len(ids), width)[order]
            own = np.array(ids, dtype=np.int64)[order]
            columns = {
                "block": pa.array([number], pa.int64()),
                "label": pa.array([label], kind),
                "n_anchors": pa.array([int((own % every == 0).sum())], pa.int64()),
            } | {n: pa.array([x.tobytes()], pa.binary()) for n, x in (("low", matrix.min(axis=0)), ("high", matrix.max(axis=0)), ("ids", own), ("vectors", matrix))}
            number += 1
            return pa.RecordBatch.from_arrays([*columns.values()], [*columns])

        for batch in batches:
            kind = batch.schema.field("label").type
            for i, y, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if ids and (y != label or len(ids) == size):
                    yield made()
                    ids, vectors = [], []
                if (i, y, v) != before:
                    label, before = y, (i, y, v)
                    ids.append(i)
                    vectors.append(v)
        if ids:
            yield made()

    schema = f"block long, label {labels}, n_anchors long, low binary, high binary, ids binary, vectors binary"
    return along.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(blocked, schema)


@dataclass
class Chunk:
    """Anchors, and what they look for: ``windows`` of scores per anchor (least, greatest, least worth reading)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same: bool
    best: int
    floor: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def wanted(self, label: object, low: np.ndarray, high: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The anchors for which a block of the label may hold a row in a window, by interval arithmetic."""
        kin = np.flatnonzero((self.labels == label) == self.same)
        own = self.vectors[kin]
        up, down = np.maximum(own, 0), np.minimum(own, 0)
        upper, lower = up @ high + down @ low, up @ low + down @ high
        meets = (lower[:, None] <= self.most[kin]) & (upper[:, None] >= np.maximum(floor[kin], self.least[kin]))
        return kin[meets.any(axis=1)]


def search(blocks: DataFrame, chunk: Chunk, extra: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """For each window of each anchor, the best rows of each task: ``extra``'s columns, ``other`` and ``score``."""
    # plain values: the class goes with the function, by value
    held = blocks.sparkSession.sparkContext.broadcast(tuple(getattr(chunk, f.name) for f in fields(chunk)))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Chunk(*held.value)
        shape = (*look.floor.shape, look.best)
        scores, others = np.full(shape, LOW), np.full(shape, HIGH)
        floor = look.floor.copy()
        for batch in batches:
            for i in range(batch.num_rows):
                label = batch.column(0)[i].as_py()
                low, high, matrix = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int32).astype(look.vectors.dtype) for c in (1, 2, 4))
                wanted = look.wanted(label, low, high, floor)
                if not len(wanted):
                    continue
                ids = np.frombuffer(batch.column(3)[i].as_py(), dtype=np.int64)
                found = (matrix.reshape(len(ids), -1) @ look.vectors[wanted].T).astype(np.int64)
                other = ids[:, None] != look.ids[wanted]
                for w in range(shape[1]):
                    inside = (found >= np.maximum(floor[wanted, w], look.least[wanted, w])) & (found <= look.most[wanted, w]) & other
                    some = np.flatnonzero(inside.any(axis=0))
                    if not len(some):
                        continue
                    worth = np.where(inside[:, some], found[:, some], LOW)
                    # ids ascend, so a stable sort puts the smaller of equal scores first
                    top = np.argsort(-worth.clip(LOW + 1), axis=0, kind="stable")[: look.best]
                    own = wanted[some]
                    both = np.concatenate([scores[own, w], np.take_along_axis(worth, top, axis=0).T], axis=1)
                    named = np.concatenate([others[own, w], np.where(np.take_along_axis(worth, top, axis=0).T == LOW, HIGH, ids[top].T)], axis=1)
                    order = np.lexsort((named, -both.clip(LOW + 1)), axis=-1)[:, : look.best]
                    scores[own, w] = np.take_along_axis(both, order, axis=1)
                    others[own, w] = np.take_along_axis(named, order, axis=1)
                    floor[own, w] = np.maximum(floor[own, w], scores[own, w, -1])
        a, w, k = np.nonzero(scores > LOW)
        columns = extra(a, w) | {"other": others[a, w, k], "score": scores[a, w, k]}
        for at in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(columns[n][at : at + (1 << 16)]) for n in names], names)

    return blocks.select("label", "low", "high", "ids", "vectors").mapInArrow(run, schema)


def _ranged(cells: list[int], ranges: int = RANGES) -> list[tuple[int, int]]:
    """The cells as ranges from first to last, the nearest ones put together until there are few enough."""
    if not cells:
        return []
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(cells, cells[1:], strict=False)) if b > a + 1), reverse=True)
    cuts = sorted(i for _, i in gaps[: ranges - 1])
    starts = [0, *(i + 1 for i in cuts)]
    return [(cells[a], cells[b]) for a, b in zip(starts, [*cuts, len(cells) - 1], strict=True)]


@dataclass
class Index:
    """Written blocks, and where each task's begin in the numbering of all."""

    blocks: DataFrame
    width: int
    exact: np.dtype
    starts: dict[int, int]
    total: int

    @classmethod
    def build(cls, rows: DataFrame, every: int = EVERY, size: int = BLOCK) -> Index:
        rows = settled(usable(rows), "vectors")
        widest, greatest = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
        width = widest or 0
        most = min(LIMIT, math.ceil(SCALE * (greatest or 0.0)) + 1 if (greatest or 0.0) < LIMIT else LIMIT)
        # in doubles, sums of products are exact below 2 ** 53
        exact = np.dtype(np.float64 if width * most * most < 1 << 53 else np.int64)
        blocks = settled(build_blocks(rows, width, every, size), "vector-blocks")
        counts = blocks.groupBy(F.shiftright("block", 32).alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()
        starts, total = {}, 0
        for r in counts:
            starts[r.task] = total
            total += r.n
        return cls(blocks, width, exact, starts, total)

    def number(self):
        """The place of a block among all, as a column."""
        pairs = [x for task, start in self.starts.items() for x in (F.lit(task), F.lit(start))]
        begin = F.try_element_at(F.create_map(*pairs), F.shiftright("block", 32)) if pairs else F.lit(0)
        return begin + F.col("block").bitwiseAND(0xFFFFFFFF)

    def chunks(self, size: int = CHUNK) -> list[tuple[int, int]]:
        """Ranges of blocks, each with ``size`` anchors or up to a block's more."""
        held = self.blocks.where("n_anchors > 0").select("block", "n_anchors", F.shiftright("block", 32).alias("task"))
        by_task = {r.task: r.n for r in held.groupBy("task").agg(F.sum("n_anchors").alias("n")).collect()}
        before, total = {}, 0
        for task in sorted(by_task):
            before[task] = total
            total += by_task[task]
        if not total:
            return []
        pairs = [x for task, n in before.items() for x in (F.lit(task), F.lit(n))]
        along = Window.partitionBy("task").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        at = F.try_element_at(F.create_map(*pairs), F.col("task")) + F.coalesce(F.sum("n_anchors").over(along), F.lit(0))
        dealt = held.select("block", F.floor(at / size).alias("chunk")).groupBy("chunk").agg(F.min("block").alias("a"), F.max("block").alias("b"))
        return [(r.a, r.b) for r in dealt.orderBy("chunk").collect()]

    def anchors(self, part: tuple[int, int], every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, labels and vectors of the anchors of a chunk, which is bounded."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = np.frombuffer(batch.column(1)[i].as_py(), dtype=np.int64)
                    own = ids % every == 0
                    matrix = np.frombuffer(batch.column(2)[i].as_py(), dtype=np.int32).reshape(len(ids), width)[own]
                    columns = [pa.array(ids[own]), batch.column(0).take(pa.array(np.full(own.sum(), i))), pa.array([v.tobytes() for v in matrix], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "label", "v"])

        kind = self.blocks.schema["label"].dataType.simpleString()
        held = self.blocks.where(F.col("block").between(*part) & (F.col("n_anchors") > 0)).select("label", "ids", "vectors")
        rows = held.mapInArrow(run, f"id long, label {kind}, v binary").toArrow()
        vectors = np.frombuffer(b"".join(rows["v"].to_pylist()), dtype=np.int32).reshape(len(rows), width).astype(self.exact)
        return rows["id"].to_numpy(), np.array(rows["label"].to_pylist()), vectors

    def needed(self, chunk: Chunk) -> DataFrame:
        """The blocks that some anchor's windows may meet: ranges of blocks that hold them all, by zone maps alone."""
        share = max(1, math.ceil(self.total / CELLS))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for i in range(batch.num_rows):
                    low, high = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int32).astype(chunk.vectors.dtype) for c in (2, 3))
                    keep.append(bool(len(chunk.wanted(batch.column(1)[i].as_py(), low, high, chunk.floor))))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["block"])

        zones = self.blocks.select("block", "label", "low", "high").mapInArrow(run, "block long")
        cells = zones.select(F.floor(self.number() / share).cast("long").alias("cell")).distinct().collect()  # CELLS at most
        ranges = _ranged(sorted(r.cell for r in cells))
        if not ranges:
            return self.blocks.limit(0)
        tasks, starts = list(self.starts), list(self.starts.values())

        def block_of(number: int) -> int:
            at = int(np.searchsorted(starts, number, side="right")) - 1
            return (tasks[at] << 32) + number - starts[at]

        parts = [F.col("block").between(block_of(a * share), block_of(min(self.total, (b + 1) * share) - 1)) for a, b in ranges]
        return self.blocks.where(reduce(lambda x, y: x | y, parts))

    def first(self, blocks: int = FIRST_BLOCKS) -> list[int]:
        """A few blocks spread over all, the same in every run."""
        return [r.block for r in self.blocks.select("block").orderBy(F.xxhash64("block")).limit(blocks).collect()]


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, chunk_size: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """For each anchor and positive the hardest negatives: anchor_id, positive_id, rank, negative_id and both scores.

    Only vec_id, label and embedding are read, whatever other columns are called. Rows with a null among them, or
    a component that is null or not finite, take no part. Equal rows count once; rows of one id that differ are
    rows of their own, but never partners. Shorter vectors are filled up with zeros. A component beyond
    ``LIMIT / SCALE`` (131,072) counts as that. Without anchors the result is empty.
    """
    spark = rows.sparkSession
    index = Index.build(sheltered(rows, "vec_id", "label", "embedding")[0], every, block)
    made = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    first = index.first()
    for part in index.chunks(chunk_size):
        ids, labels, vectors = index.anchors(part, every)

        def reached(chunk: Chunk, at: list[int] | tuple[int, int]) -> np.ndarray:
            """The score of the last wanted row of each window among a few blocks, or the least of all."""
            held = F.col("block").between(*at) if isinstance(at, tuple) else F.col("block").isin(at)
            near = index.blocks.where(held)
            found = search(near, chunk, lambda a, w: {"a": a, "w": w}, "a long, w long, other long, score long")
            last = _best(found, ["a", "w"], chunk.best).where(F.col("rank") == chunk.best).select("a", "w", "score").toArrow()
            floor = chunk.floor.copy()
            floor[last["a"].to_numpy(), last["w"].to_numpy()] = last["score"].to_numpy()
            return floor

        def some(value: int, n: int = 1, rows: int = len(ids)) -> np.ndarray:
            return np.full((rows, n), value, dtype=np.int64)

        like = Chunk(ids, labels, vectors, True, positives, some(LOW), some(LOW), some(HIGH))
        like.floor = reached(like, part)
        found = search(index.needed(like), like, lambda a, w: {"a": a}, "a long, other long, score long")
        best = _best(found, ["a"], positives).select("a", "rank", "other", "score").toArrow()
        a, place = best["a"].to_numpy(), best["rank"].to_numpy() - 1
        partner, score, there = some(0, positives), some(0, positives), some(0, positives).astype(bool)
        partner[a, place], score[a, place], there[a, place] = best["other"].to_numpy(), best["score"].to_numpy(), True

        least, most = -(-LEAST * score // 100), MOST * score // 100
        least[~there], most[~there] = 1, 0  # an empty window, as one of a negative score is
        unlike = Chunk(ids, labels, vectors, False, negatives, some(LOW, positives), least, most)
        unlike.floor = reached(unlike, first)

        def named(a: np.ndarray, w: np.ndarray, ids=ids, partner=partner, score=score) -> dict[str, np.ndarray]:
            return {"a": a, "w": w, "anchor_id": ids[a], "positive_id": partner[a, w], "positive_score": score[a, w]}

        schema = "a long, w long, anchor_id long, positive_id long, positive_score long, other long, score long"
        hard = _best(search(index.needed(unlike), unlike, named, schema), ["a", "w"], negatives)
        shown = hard.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        made = made.unionByName(settled(shown, "hard-negatives"))
    return made


def relabelled(rows: DataFrame, divisor: int = 7, labels: int = 10) -> DataFrame:
    """``rows`` with the next label, modulo ``labels``, where the id is divisible by ``divisor``."""
    moved = F.when(F.col("vec_id") % divisor == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.withColumn("label", moved)


ORACLE_SQL = f"""
WITH rows AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM rows AS a JOIN rows AS b ON a.id % {EVERY} = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives AS p JOIN pairs AS n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND {LEAST} * p.positive_score <= 100 * n.score AND 100 * n.score <= {MOST} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
