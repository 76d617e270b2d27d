"""The trie of conversation prefixes with totals over subtrees, rolled up by bands of depth.

Conversations are first rebuilt: each begins with some turns of the first conversation of its group. A node of
the trie is a distinct sequence of first turns; conversations that begin with it are its members.

A prefix is known by a running sum of hashes of its turns and their places, so a node finds its ancestors a few
turns back in the same conversation, and no prefix is ever a text. Totals go up by bands of a fixed height. A node
is repeated only for its ancestors in its own band, which completes the lowest band and gives the other bands
their own part. Band roots form a tree again, of a fraction of the depth, whose totals are made by the same
rule; each completed root then counts for the nodes of the band above it. So a node is repeated at most once per
place in a band and level, and the rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, sheltered, text_of

#: Conversations of one group have ids of the same whole part when divided by GROUP, and share up to MOST - 1 turns.
GROUP, MOST = 100, 6

#: Depths of a band.
BAND = 4

#: Ids that a task joins to one piece of text.
CHUNK = 1 << 14

NODE = ["ka", "kb"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``pos`` from 1, a 128-bit key of role and text (``a``, ``b``) and ``size``, the text's code points.

    Turns are in order of ``turn``, null first; ties go by role, then text. Null role or text is empty. Rows without
    a conv_id belong to no conversation.
    """
    named = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    ordered = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return named.where("conv IS NOT NULL").select(
        "conv",
        F.row_number().over(ordered).cast("long").alias("pos"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("second"), "role", "text").alias("b"),
        F.char_length("text").cast("long").alias("size"),
    )


def rebuilt(turns: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (``conv``, ``depth`` from 1, key and size), and the turnless ``conv``.

    A conversation begins with the first h turns of the first one of its group, and goes on with its own after
    its first h; h is the CRC-32 of its decimal id modulo ``most``.
    """
    conv = F.col("conv")
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    heads = (
        turns.where((conv % group == 0) & (F.col("pos") < most))  # fewer than ``most`` rows of a conversation
        .groupBy(conv.alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("head"))
    )
    plans = (
        lengths.withColumn("h", (F.crc32(conv.cast("string").cast("binary")) % most).cast("int"))
        .withColumn("base", conv - conv % group)
        .join(heads, "base", "left")
        .withColumn("head", F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))))
        .withColumn("taken", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
        .select("conv", "n", "h", "head", "taken")
    )
    shared = plans.select("conv", F.inline("head")).select("conv", F.col("pos").alias("depth"), "a", "b", "size")
    own = turns.join(plans.select("conv", "h", "taken"), "conv").where("pos > h")
    rows = shared.unionByName(own.select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "a", "b", "size"))
    return rows, plans.where("taken = 0 AND n <= h").select("conv")


def _levels(deepest: int, band: int) -> list[int]:
    """The strides of the levels: 1, band, band squared, ... until one band holds all."""
    strides = [1]
    while deepest >= strides[-1] * band:
        strides.append(strides[-1] * band)
    return strides


def prefixes(rows: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """``rows`` with the key of the prefix that ends there, its ancestors by level, and whether it is the last.

    ``up_L`` holds the ancestors at the level's stride: of a node inside a band those in the band, nearest first; of
    a band's root all of the band above; null for nodes that are not of the level. The root has the key 0, 0.
    """
    along = Window.partitionBy("conv").orderBy("depth")
    sums = {
        f"s{i}": F.sum(F.xxhash64(F.lit(i), "depth", "a", "b").cast("decimal(20,0)")).over(along.rowsBetween(Window.unboundedPreceding, 0))
        for i in (1, 2)
    }
    keyed = rows.withColumns(sums).withColumns(
        {"ka": F.xxhash64(F.lit("a"), "depth", "s1", "s2"), "kb": F.xxhash64(F.lit("b"), "depth", "s1", "s2")}
    )
    key, depth = F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")), F.col("depth")
    top = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    ups = {}
    for level, stride in enumerate(_levels(deepest, band)):
        above = F.array(*[F.when(depth == j * stride, top).otherwise(F.lag("key", j * stride).over(along)) for j in range(1, band + 1)])
        inside = (F.floor(depth / stride) % band).cast("int")
        ups[f"up_{level}"] = F.when(depth % stride == 0, F.slice(above, F.lit(1), F.when(inside == 0, band).otherwise(inside)))
    last = F.lead("key").over(along).isNull().alias("last")
    return keyed.withColumn("key", key).select("conv", "depth", "size", *NODE, *[c.alias(n) for n, c in ups.items()], last)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_totals(nodes: DataFrame, deepest: int, band: int = BAND, level: int = 0) -> DataFrame:
    """``leaves`` and ``saved`` of each node of the level summed over its subtree, by node.

    ``nodes`` have these two as their own share, besides key, depth and the ancestors of all levels.
    """
    stride = band**level
    mine = nodes.where(F.col("depth") % stride == 0)
    values = ["leaves", "saved"]
    root_of_band = F.col("depth") % (stride * band) == 0

    def up(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(f"up_{level}").alias("up"), *values).select(F.col("up.a").alias("ka"), F.col("up.b").alias("kb"), *values)

    inside = _summed(mine.select(*NODE, *values).unionByName(up(mine.where(~root_of_band))))
    if deepest < stride * band:
        return inside
    inside = settled(inside, f"band-sums-{level}")
    roots = settled(nodes.where(root_of_band).drop(*values).join(inside, NODE), f"band-roots-{level}")
    done = subtree_totals(roots, deepest, band, level + 1)
    below = up(roots.drop(*values).join(done, NODE).where("depth > 0"))
    return _summed(inside.unionByName(below))


def ends_digest(ends: DataFrame) -> DataFrame:
    """Per node (``ka``, ``kb``) the SHA-256 of its ``conv`` in ascending order, as decimal numbers joined by commas.

    Tasks join ids of a range each to pieces of text, however many a node has; what is left for the one task that
    a digest needs, which goes through its bytes in order, is a few pieces a node, one in memory at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = None, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"ka": [own[0]], "kb": [own[1]], "first": [ids[0]], "piece": [",".join(map(str, ids))]})

        for batch in batches:
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (a, b) or len(ids) >= CHUNK:
                    if ids:
                        yield made()
                    own, ids = (a, b), []
                ids.append(conv)
        if ids:
            yield made()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, running = None, None

        def made(keys: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"ka": [k[0] for k in keys], "kb": [k[1] for k in keys], "ends_sha256": [k[2] for k in keys]})

        for batch in batches:
            done = []
            for a, b, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (a, b):
                    if running:
                        done.append((*own, running.hexdigest()))
                    own, running = (a, b), hashlib.sha256(piece.encode())
                else:
                    running.update(b"," + piece.encode())
            if done:
                yield made(done)
        if running:
            yield made([(*own, running.hexdigest())])

    ordered = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    cut = ordered.mapInArrow(pieces, "ka long, kb long, first long, piece string")
    return cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, "ka long, kb long, ends_sha256 string")


def trie(conversations: DataFrame, group: int = GROUP, most: int = MOST, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Only conv_id, turn, role and text are read, whatever other columns are called. A repeated row is one more turn. An
    empty table has no node, not even a root, as a node needs a member.
    """
    conversations = sheltered(conversations, "conv_id", "turn", "role", "text")[0]
    turns = settled(numbered_turns(conversations), "turns")
    rows, turnless = rebuilt(turns, group, most)
    rows, turnless = settled(rows, "rebuilt"), settled(turnless, "turnless")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    found = settled(prefixes(rows, deepest, band), "prefixes")
    ups = [c for c in found.columns if c.startswith("up_")]
    counted = [F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]

    zero = F.lit(0).cast("long")
    first = F.col("conv").alias("conv")
    members = found.where("depth = 1").select(first).unionByName(turnless)
    none = [F.array().cast(found.schema[c].dataType).alias(c) for c in ups]
    root = members.agg(*counted).where("n_convs > 0").select(zero.alias("ka"), zero.alias("kb"), zero.alias("depth"), zero.alias("size"), *none, "conv_id", "n_convs")
    nodes = settled(found.groupBy(*NODE, "depth", "size", *ups).agg(*counted).unionByName(root), "nodes")

    parent = F.get("up_0", F.lit(0))
    children = nodes.where("depth > 0").groupBy(parent["a"].alias("ka"), parent["b"].alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    wide = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    wide = wide.withColumns({"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("size")})
    wide = settled(wide, "nodes-with-children")
    totals = subtree_totals(wide.select(*NODE, "depth", *ups, "leaves", "saved"), deepest, band)

    ends = found.where("last").select(*NODE, "conv").unionByName(turnless.select(zero.alias("ka"), zero.alias("kb"), "conv"))
    parents = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    shown: list[Column] = [
        F.col("conv_id"),
        F.col("depth"),
        F.col("parent_conv_id"),
        F.col("n_convs"),
        F.col("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    ]
    own = wide.select(*NODE, "conv_id", "depth", "n_convs", "n_children", parent["a"].alias("pa"), parent["b"].alias("pb"))
    return own.join(totals, NODE).join(ends_digest(ends), NODE, "left").join(parents, ["pa", "pb"], "left").select(*shown)


ORACLE_SQL = f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS k, length(coalesce(text, '')) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv, conv - conv % {GROUP} AS base, max(pos) AS n, list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
        FROM turns GROUP BY conv),
bits AS (SELECT *, flatten(list_transform(bytes, lambda x: list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: (x >> i) & 1))) AS bits FROM ids),
plans AS (SELECT conv, base, n, xor(list_reduce(bits, lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384), 4294967295), 4294967295) % {MOST} AS h FROM bits),
heads AS (SELECT p.conv, t.pos AS depth, t.k, t.size FROM plans AS p JOIN turns AS t ON t.conv = p.base AND t.pos <= p.h),
taken AS (SELECT conv, count(*) AS taken FROM heads GROUP BY conv),
whole AS (SELECT * FROM heads
          UNION ALL
          SELECT t.conv, coalesce(taken, 0) + t.pos - p.h, t.k, t.size
          FROM turns AS t JOIN plans AS p ON t.conv = p.conv LEFT JOIN taken AS a ON a.conv = t.conv WHERE t.pos > p.h),
seqs AS (SELECT p.conv, coalesce(string_agg(w.k, '' ORDER BY w.depth), '') AS seq, coalesce(list(w.size ORDER BY w.depth) FILTER (WHERE w.size IS NOT NULL), []) AS sizes
         FROM plans AS p LEFT JOIN whole AS w ON w.conv = p.conv GROUP BY p.conv),
exploded AS (SELECT conv, seq, unnest(range(length(seq) // 32 + 1)) AS depth, sizes FROM seqs),
nodes AS (SELECT left(seq, 32 * depth) AS prefix, depth, min(conv) AS conv_id, count(*) AS n_convs,
                 max(CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END) AS size,
                 coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (WHERE length(seq) = 32 * depth), '') AS ends
          FROM exploded GROUP BY 1, 2),
children AS (SELECT left(prefix, 32 * (depth - 1)) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes AS n LEFT JOIN children AS c ON c.prefix = n.prefix),
ups AS (SELECT left(prefix, 32 * step) AS prefix, n_children, (n_convs - 1) * size AS saved
        FROM (SELECT *, unnest(range(depth + 1)) AS step FROM own)),
totals AS (SELECT prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved FROM ups GROUP BY prefix)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, t.n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own AS o JOIN totals AS t ON t.prefix = o.prefix LEFT JOIN nodes AS p ON o.depth > 0 AND p.prefix = left(o.prefix, 32 * (o.depth - 1))
"""
