"""Near copies by SimHash fingerprints: vantage-point trees find all pairs a few bits apart.

A fingerprint belongs to a shard of the tree by its Hamming distances to vantage points. At a vantage
point of radius r, fingerprints up to r + bits away go to the near side and those beyond r to the far
side, so a pair within ``bits`` meets in a shard even where it lies astride a boundary: by the triangle
inequality the far one of the pair is at most ``bits`` beyond the radius. The first tree is built from a sample
of all fingerprints; a shard that is still too large gets a tree of its own from a sample of it, round by round over the
cluster, so shards do not grow with the corpus. Inside a shard the same rule
splits on until what is left is compared outright. A shard returns a star per class it sees, never
all pairs; classes that reach over shards are joined by star contraction over the edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, sheltered, text_key, text_of

SHINGLE = 3
BITS = 2

#: Fingerprints from which the upper tree is built on the driver; the only ones it ever sees.
SAMPLE = 8192

#: Fingerprints a shard should hold; the tree stops splitting earlier where the sample gets too thin.
SHARD = 8192

#: A shard of more than this many times SHARD is split again; its sample is as large as the first one.
OVER = 4

#: Fingerprints of a shard that one task routes.
ROUTED = 1 << 20

#: Blocks of this size are compared pair by pair.
BLOCK = 1024

#: A split that leaves more than this share of the comparisons is not worth making.
WORTH = 0.8


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: words split at ASCII white space, A-Z lower-cased; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only, both for case and space
    if not words:
        return 0
    runs = zip(*[words[i:] for i in range(shingle)], strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(run), 42) for run in runs), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text that tells texts apart under one doc_id, and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made.view(np.int64))], ["doc_id", "t", "fp"])

    named = docs.select("doc_id", text_key(text_of("text"))["a"].alias("t"), text_of("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(run, f"doc_id {kind}, t long, fp long")


def _split(points: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[int, int, float] | None:
    """The vantage point and radius, of a few tried, that leave the fewest comparisons, and their share."""
    best, n = None, len(points)
    for centre in points[rng.choice(n, size=min(6, n), replace=False)]:
        upto = np.bincount(np.bitwise_count(points ^ centre), minlength=65)[:65].cumsum()
        near = upto[np.minimum(np.arange(65) + bits, 64)] / n
        far = 1 - upto / n
        cost = near**2 + far**2
        radius = int(cost.argmin())
        if best is None or cost[radius] < best[2]:
            best = (int(centre), radius, float(cost[radius]))
    return best if best[2] <= WORTH else None


def build_tree(sample: np.ndarray, total: int, bits: int = BITS, shard: int = SHARD) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, near child, far child); a child below 0 is shard number -child - 1."""
    nodes: list[tuple[int, int, int, int]] = []
    rng, shards = np.random.default_rng(7), 0
    scale = total / max(len(sample), 1)

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        found = None
        if len(points) * scale > shard and len(points) >= 32:
            found = _split(points, bits, rng)
        if found is None:
            shards += 1
            return -shards
        centre, radius, _ = found
        place = len(nodes)
        nodes.append((0, 0, 0, 0))
        distance = np.bitwise_count(points ^ np.uint64(centre))
        near, far = grow(points[distance <= radius + bits]), grow(points[distance > radius])
        nodes[place] = (centre, radius, near, far)
        return place

    grow(sample)
    return nodes


def _route(points: np.ndarray, nodes: list, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shards that each of the points belongs to."""
    waiting = [(0 if nodes else -1, points)]
    while waiting:
        place, part = waiting.pop()
        if not len(part):
            continue
        if place < 0:
            yield -place - 1, part
            continue
        centre, radius, near, far = nodes[place]
        distance = np.bitwise_count(part ^ np.uint64(centre))
        waiting += [(near, part[distance <= radius + bits]), (far, part[distance > radius])]


def classes(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """For distinct sorted fingerprints, the place of the first one that each is linked to by steps of ``bits``."""
    parent = np.arange(len(points))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)

    rng = np.random.default_rng(11)
    waiting = [np.arange(len(points))]
    while waiting:
        own = waiting.pop()
        found = _split(points[own], bits, rng) if len(own) > BLOCK else None
        if found:
            distance = np.bitwise_count(points[own] ^ np.uint64(found[0]))
            waiting += [own[distance <= found[1] + bits], own[distance > found[1]]]
            continue
        part = points[own]
        for i in range(0, len(part), BLOCK):
            rows = part[i : i + BLOCK]
            for j in range(i, len(part), BLOCK):
                a, b = np.nonzero(np.bitwise_count(rows[:, None] ^ part[None, j : j + BLOCK]) <= bits)
                later = a + i < b + j
                a, b = own[a[later] + i], own[b[later] + j]
                if len(a) > 4 * BLOCK:  # a dense block: pairs whose ends are known to be joined need no step each
                    seen = pd.DataFrame({"a": [root(x) for x in a.tolist()], "b": b}).drop_duplicates()
                    a, b = seen["a"].to_numpy(), seen["b"].to_numpy()
                join(a, b)
    return np.array([root(i) for i in range(len(points))], dtype=np.int64)


def _packed(nodes: list[tuple[int, int, int, int]]) -> bytes:
    return b"".join(np.uint64(c).tobytes() + np.array(n, dtype=np.int64).tobytes() for c, *n in nodes)


def _unpacked(tree: bytes) -> list[tuple[int, int, int, int]]:
    whole = np.frombuffer(tree, dtype=np.int64).reshape(-1, 4)
    return list(zip(whole[:, 0].view(np.uint64).tolist(), *whole[:, 1:].T.tolist(), strict=True))


def _again(points: DataFrame, large: DataFrame, bits: int, sample: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """The points of the large shards (``shard``, ``n``) dealt to smaller ones by a tree each, and those that no tree splits.

    Samples and trees are bounded per shard. A tree travels to the tasks that have the shard's points ahead of
    them, so a task holds one tree and one batch; a shard of very many points goes to several tasks.
    """
    held = points.join(large, "shard")
    drawn = held.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) <= F.lit(float(sample) * (1 << 30)) / F.col("n"))

    def grown(group: pa.Table) -> pa.Table:
        own = group.column("fp").to_numpy().view(np.uint64)
        nodes = build_tree(np.sort(own), group.column("n")[0].as_py(), bits, shard)
        return group.slice(0, 1).select(["shard", "n"]).append_column("tree", pa.array([_packed(nodes)], pa.binary()))

    trees = settled(drawn.groupBy("shard").applyInArrow(grown, "shard long, n long, tree binary"), "shard-trees")
    tasks = F.ceil(F.col("n") / ROUTED)
    splits = trees.where("octet_length(tree) > 0")
    ahead = splits.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1)).alias("task"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("fp"), "tree")
    behind = held.join(splits.select("shard"), "shard", "left_semi").select(
        "shard", F.pmod(F.xxhash64("fp"), tasks).alias("task"), F.lit(1).alias("kind"), "fp", F.lit(None).cast("binary").alias("tree")
    )
    kinds = np.dtype([("shard", np.int64), ("place", np.int64)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: list = []
        for batch in batches:
            first = np.flatnonzero(batch.column(2).to_numpy() == 0)
            for begin, end in zip([0, *first], [*first, batch.num_rows], strict=True):
                part = batch.slice(begin, end - begin)
                if part.num_rows and part.column(2)[0].as_py() == 0:
                    tree, part = _unpacked(part.column(4)[0].as_py()), part.slice(1)
                if part.num_rows:
                    own, fps = part.column(0)[0].as_py(), part.column(3).to_numpy().view(np.uint64)
                    for place, found in _route(fps, tree, bits):
                        # a shard's name is the hash of its parent's and its place there
                        name = xxhash.xxh64_intdigest(np.array([(own, place)], dtype=kinds).tobytes()) >> 1
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), name, dtype=np.int64)), pa.array(found.view(np.int64))], ["shard", "fp"])

    dealt = ahead.unionByName(behind).repartition("shard", "task").sortWithinPartitions("shard", "task", "kind")
    whole = held.join(trees.where("octet_length(tree) = 0").select("shard"), "shard", "left_semi")
    return settled(dealt.mapInArrow(route, "shard long, fp long"), "shards"), whole


def _blockwise(whole: DataFrame, shard: int) -> DataFrame:
    """Points of shards that no tree splits, dealt to pairs of blocks: each two points meet, and no task holds more than two blocks."""
    blocks = F.ceil(F.col("n") / shard)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    paired = whole.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("blocks"))).select("shard", "fp", "own", other)
    return paired.select(F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp")


def sharded(nodes: DataFrame, bits: int = BITS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """``shard`` and ``fp``: every two fingerprints within ``bits`` are in some shard together.

    No shard has more than OVER times ``shard`` fingerprints, however many there are.
    """
    total = nodes.count()
    picked = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    tree = build_tree(np.array([r.fp for r in picked], dtype=np.int64).view(np.uint64), total, bits, shard)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for place, part in _route(points, tree, bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), place)), pa.array(part.view(np.int64))], ["shard", "fp"])

    points = settled(nodes.select("fp").mapInArrow(route, "shard long, fp long"), "shards")
    done: list[DataFrame] = []
    while True:
        sizes = points.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        large = settled(sizes.where(F.col("n") > OVER * shard), "large-shards")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done, points)
        done.append(points.join(large.select("shard"), "shard", "left_anti"))
        points, whole = _again(points, large, bits, sample, shard)
        done.append(_blockwise(whole, shard))


def links(nodes: DataFrame, bits: int = BITS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Edges ``u`` > ``v`` between distinct fingerprints (column ``fp``) that connect exactly the linked ones."""

    def star(group: pa.Table) -> pa.Table:
        points = np.sort(group.column("fp").to_numpy()).view(np.uint64)
        first = classes(points, bits)
        other = first != np.arange(len(points))
        return pa.table({"u": points[other].view(np.int64), "v": points[first[other]].view(np.int64)})

    return sharded(nodes, bits, sample, shard).groupBy("shard").applyInArrow(star, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of the edges can reach: ``u`` and ``root``, for all but the roots.

    Large stars and small stars in turn, until no edge changes. Each node then points to its root.
    Edges of a hub are rows of a join that adaptive execution splits; none is gathered in one place.
    """
    edges = settled(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").selectExpr("v AS u", "m AS v").union(lowest).where("u <> v").distinct()
        edges = settled(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.withColumnRenamed("v", "root")
        mark = now


def grouped(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``t``, ``fp``, component_id, and the ``root`` and ``keeper`` of its class.

    Equal fingerprints are one node, whatever the number of their documents. component_id is the smallest
    doc_id that can be reached, rows without one not counting. ``keeper`` is the row that stands for the
    class: the smallest doc_id, then text hash.
    """
    docs, _ = sheltered(docs, "doc_id", "text")
    rows = settled(fingerprints(docs, shingle), "fingerprints")
    # nulls come last: the flag is compared first
    named = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("t"))
    nodes = settled(rows.groupBy("fp").agg(F.min(named).alias("keeper")), "fingerprint-nodes")
    roots = components(links(nodes, bits, sample, shard))
    labelled = nodes.join(roots, nodes["fp"] == roots["u"], "left").select("fp", "keeper", F.coalesce("root", "fp").alias("root"))
    best = labelled.groupBy("root").agg(F.min("keeper").alias("keeper"))
    classes_of = labelled.select("fp", "root").join(best, "root")
    return rows.join(classes_of, "fp").select("doc_id", "t", "fp", "root", "keeper", F.col("keeper.doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint in 16 hex digits, and component_id.

    A null or empty text has fingerprint zero and is linked like any other. Only doc_id and text are
    read. Equal rows share a class. If no row of a class has a doc_id, its component_id is null.
    """
    found = grouped(docs, shingle, bits)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` of which one stays for each class, with all their columns."""
    docs, restored = sheltered(docs, "doc_id", "text")
    found = grouped(docs, shingle, bits)
    stays = found.select(F.col("keeper.doc_id").alias("_id"), F.col("keeper.t").alias("_t")).distinct()
    keyed = docs.withColumn("_k", text_key(text_of(docs["text"]))["a"])
    same = keyed["doc_id"].eqNullSafe(stays["_id"]) & (keyed["_k"] == stays["_t"])
    return restored(keyed.join(stays, same, "left_semi").dropDuplicates(["doc_id", "_k"]))
