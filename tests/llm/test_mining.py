"""Toxicity, the conversation trie and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortrates.llm import hard_negatives, prefix_trie, toxicity

from .conftest import prose

# --- toxicity -----------------------------------------------------------------------------------------------

RUDE = "idiot moron clown".split()


def rude_rows(n: int = 700) -> list[tuple[int, str, int]]:
    rng, made = random.Random(5), []
    for i in range(n):
        words, toxic = prose(i, rng.randrange(5, 80)).split(), int(rng.random() < 0.25)
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), rng.choice(RUDE))
        made.append((i, " ".join(words), toxic))
    return made


@pytest.fixture(scope="module")
def rude(spark):
    rows = rude_rows()
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_toxic_texts_of_held_out_rows_are_found(rude):
    rows, docs, labels = rude
    found = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(found) == len(rows) and all(found[i].held_out == is_held_out(i) for i, _, _ in rows)
    kept = [(found[i].predicted, y) for i, _, y in rows if is_held_out(i)]
    assert sum(y for _, y in kept) > 20
    assert sum(p == y for p, y in kept) / len(kept) > 0.95
    assert all(r.predicted == int(r.score >= toxicity.THRESHOLD) for r in found.values())


def test_scores_are_those_of_a_plain_version(spark, rude):
    """One shard and one round is plain FTRL-proximal over the training texts in the order of their hashes."""
    rows, docs, labels = rude
    model = toxicity.fit(docs, labels, rounds=1)
    keyed = toxicity.training_rows(docs, labels).select("a", "b", "text", "toxic").collect()
    z, n, rates = {}, {}, toxicity.Rates()

    def weight(b):
        if abs(z.get(b, 0.0)) <= rates.l1:
            return 0.0
        return (math.copysign(rates.l1, z[b]) - z[b]) / ((rates.beta + math.sqrt(n[b])) / rates.alpha + rates.l2)

    made = toxicity.Buckets()
    for r in sorted(keyed, key=lambda r: (r.a, r.b, r.toxic)):
        own = made.of(r.text).tolist()
        w = {b: weight(b) for b in own}
        g = 1 / (1 + math.exp(-sum(w.values()))) - r.toxic
        for b in own:
            before = n.get(b, 0.0)
            n[b] = before + g * g
            z[b] = z.get(b, 0.0) + g - (math.sqrt(n[b]) - math.sqrt(before)) / rates.alpha * w[b]
    plain = {b: weight(b) for b in z if weight(b)}
    assert len(plain) > 5 and dict(zip(model["buckets"].tolist(), model["weights"].tolist(), strict=True)) == pytest.approx(plain, rel=1e-4)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs.drop("score"), model, ["doc_id"]).collect()}
    for i, text, _ in rows[:100]:
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-sum(plain.get(b, 0.0) for b in made.of(text).tolist()))), rel=1e-3)


def test_labels_of_held_out_rows_are_not_read(spark, rude):
    rows, docs, labels = rude
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x, shard=100, rounds=2) for x in (labels, flipped))
    assert a["buckets"].tolist() == b["buckets"].tolist() and a["weights"].tolist() == b["weights"].tolist()


def test_shards_learn_alike_however_rows_are_dealt(rude):
    _, docs, labels = rude
    a = toxicity.fit(docs.repartition(7), labels.repartition(3), shard=100)
    b = toxicity.fit(docs.coalesce(1), labels, shard=100)
    assert a["buckets"].tolist() == b["buckets"].tolist() and a["weights"].tolist() == b["weights"].tolist()
    assert 5 < len(a["buckets"]) < 2000


def test_toxicity_of_odd_rows(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (0, 0), (None, 1), (2, None), (999, 1)], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.doc_id in (200, 201)} == {next(r.score for r in found if r.doc_id == 203)}
    assert toxicity.score_documents(no_docs, labels).collect() == []
    unlabelled = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_words_are_hashed_in_their_order():
    made = toxicity.Buckets()
    assert made.of("").tolist() == [toxicity.BIAS]
    assert made.of("A b").tolist() == made.of("a B!").tolist() != made.of("b a").tolist()
    assert len(made.of("a b c d")) == 4 + 3 + 2 + 1 + 1


# --- conversation trie ---------------------------------------------------------------------------------------


def plain_trie(rows: list[tuple], group: int = prefix_trie.GROUP, most: int = prefix_trie.MOST) -> list[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = tuple(own.get(c - c % group, [])[:h] + turns[h:])
    members: dict[tuple, list] = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children: dict[tuple, int] = {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, own_members in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own_members) - 1) * len(p[-1][1]) if p else 0
    made = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        made.append((min(m), len(p), up, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return made


def shown(found) -> list[tuple]:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def conversations(seed: int, n: int, turns: int, texts: int) -> list[tuple]:
    rng = random.Random(seed)
    made = []
    for c in rng.sample(range(n * 3), n):
        for t in range(rng.randrange(turns)):
            made.append((c, t, rng.choice(["user", "assistant"]), f"tëxt {rng.randrange(texts)}"))
    return made


ODD = [
    (1, None, "user", "late"), (1, None, None, "early"), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "user", "tie"), (1, 0, "a", "tie"),
    (None, 0, "user", "nobody"), (None, None, None, None), (2, 5, "x", "\U0001f600 wide"), (2, 5, "x", "\U0001f600 wide"), (3, 1, "", ""), (103, 1, "", ""), (203, 1, "b", "c"),
]


@pytest.mark.parametrize("band", [2, 4])
@pytest.mark.parametrize(
    "rows",
    [ODD, conversations(1, 300, 7, 2), ODD + conversations(2, 40, 3, 1), conversations(3, 12, 70, 1) + [(500 + i, t, "u", "same") for i in range(9) for t in range(40)]],
    ids=["odd", "bushy", "copies", "deep"],
)
def test_trie_is_that_of_a_plain_version(spark, rows, band):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, KA string").repartition(5)
    assert shown(prefix_trie.trie(frame, band=band)) == sorted(plain_trie(rows), key=str)


def test_trie_of_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], kind)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], kind)).collect() == []


def test_many_ends_of_one_node_are_hashed_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    ends = spark.range(1000).selectExpr("id % 2 AS ka", "5L AS kb", "id - 300 AS conv").repartition(9)
    found = {r.ka: r.ends_sha256 for r in prefix_trie.ends_digest(ends).collect()}
    wanted = {k: hashlib.sha256(",".join(str(i - 300) for i in range(1000) if i % 2 == k).encode()).hexdigest() for k in (0, 1)}
    assert found == wanted


def test_a_node_is_repeated_for_the_ancestors_of_its_band_only(spark):
    rows = spark.createDataFrame([(1, d, d, d, 1) for d in range(1, 65)], "conv long, depth long, a long, b long, size long")
    found = {r.depth: r for r in prefix_trie.prefixes(rows, 64, band=4).collect()}
    assert all(len(r[f"up_{level}"] or []) <= 4 for r in found.values() for level in range(4))
    keys = {d: (r.ka, r.kb) for d, r in found.items()} | {0: (0, 0)}
    assert [tuple(x) for x in found[7].up_0] == [keys[6], keys[5], keys[4]] and found[7].up_1 is None
    assert [tuple(x) for x in found[8].up_0] == [keys[7], keys[6], keys[5], keys[4]]
    assert [tuple(x) for x in found[8].up_1] == [keys[4], keys[0]]
    assert [tuple(x) for x in found[64].up_3] == [keys[0]]


# --- hard negatives ------------------------------------------------------------------------------------------


def plain_negatives(rows: list[tuple], every: int) -> list[tuple]:
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable[(i, label, tuple(math.floor(256 * x) for x in v))] = None
    made = []
    for i, label, v in usable:
        if i % every:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=False)), j, y) for j, y, w in usable if j != i]
        for s, p, _ in sorted((x for x in scores if x[2] == label), key=lambda x: (-x[0], x[1]))[:5]:
            fits = sorted(((t, j) for t, j, y in scores if y != label and 50 * s <= 100 * t <= 95 * s), key=lambda x: (-x[0], x[1]))
            made += [(i, p, k + 1, j, s, t) for k, (t, j) in enumerate(fits[:3])]
    return sorted(made)


def vectors(seed: int, n: int, width: int, labels: int, spread: float) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    own = rng.integers(0, 6, n)
    made = (centres[own] + spread * rng.normal(size=(n, width))).round(2)
    return [(int(i), int(y), v.tolist()) for i, y, v in zip(rng.permutation(n * 2)[:n], rng.integers(0, labels, n), made, strict=True)]


KIND = "vec_id long, label int, embedding array<float>, score long, rank int"

ODD_VECTORS = [
    (None, 1, [1.0, 2.0]), (5, None, [1.0, 2.0]), (10, 1, None), (15, 1, [1.0, None]), (20, 1, [float("nan"), 1.0]), (25, 1, [float("inf"), 1.0]), (30, 1, []), (35, 2, [3.0]),
    (40, 1, [1.0, 1.0]), (41, 1, [2.0, 0.0]), (42, 1, [2.0, 0.0]), (43, 2, [1.5, 0.25]), (44, 3, [1.75, 0.0]), (44, 3, [1.75, 0.0]), (45, 1, [-1.0, -1.0]), (50, 2, [0.0, 0.0]),
    (55, 1, [-2.0, 0.5]), (60, 4, [5.0, 5.0, 5.0]), (61, 2, [1.25, 0.25, 0.0]), (62, 2, [1.25, 0.25, 9.0]), (-5, 1, [0.5, 0.5]), (-6, 2, [0.5, 0.25]),
]


@pytest.mark.parametrize(
    ("rows", "block", "chunk"),
    [(ODD_VECTORS, 2, 3), (ODD_VECTORS, 512, 100), (vectors(1, 400, 4, 3, 0.1), 16, 20), (vectors(2, 300, 12, 2, 1.0), 32, 1000), ([(i, i % 2, [1.0, 1.0 + i % 3]) for i in range(120)], 8, 7)],
    ids=["odd", "odd-one-block", "clustered", "wide", "ties"],
)
def test_negatives_are_those_of_a_plain_version(spark, rows, block, chunk):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], KIND).repartition(3)
    found = hard_negatives.mine(frame, every=5, block=block, chunk_size=chunk)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, 5)


def test_large_components_are_counted_in_whole_numbers(spark):
    rows = [(i, i % 2, [(99_999.0 - i) * (1 - i % 10 / 12)] * 16) for i in range(60)]
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], KIND)
    index = hard_negatives.Index.build(frame)
    assert index.exact == np.int64
    wanted = [r for r in plain_negatives([(i, y, [float(np.float32(x)) for x in v]) for i, y, v in rows], 5)]
    assert wanted and sorted(tuple(r) for r in hard_negatives.mine(frame, every=5).collect()) == wanted


def test_no_anchors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], KIND)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, 1, [1.0], 0, 0)], KIND)).collect() == []
    moved = hard_negatives.relabelled(spark.createDataFrame([(7, 9, [1.0], 0, 0), (8, 9, [1.0], 0, 0), (14, None, [1.0], 0, 0)], KIND))
    assert [r.label for r in moved.collect()] == [0, 9, None]


def test_neighbours_on_the_curve_are_neighbours_in_space():
    bits, axes = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    place = hard_negatives.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert steps.tolist() == [1] * (len(cells) - 1)


def test_zone_maps_leave_out_blocks_that_no_window_meets(spark):
    rows = vectors(4, 2000, 6, 2, 0.02)
    index = hard_negatives.Index.build(spark.createDataFrame([(*r, 0, 0) for r in rows], KIND), every=5, size=16)
    part = index.chunks(10)[0]
    ids, labels, matrix = index.anchors(part, 5)
    low, high = np.full((len(ids), 1), hard_negatives.LOW), np.full((len(ids), 1), hard_negatives.HIGH)
    scores = np.array([[sum(a * b for a, b in zip(w, v, strict=True)) for w in matrix] for v in hard_negatives.whole_numbers([np.array(r[2]) for r in rows], 6)])
    fifth = np.sort(np.where(np.array([r[1] for r in rows])[:, None] == labels, scores, hard_negatives.LOW), axis=0)[-6][:, None].astype(np.int64)
    chunk = hard_negatives.Chunk(ids, labels, matrix, True, 5, fifth, low, high)
    read = index.needed(chunk)
    assert 0 < read.count() < index.total / 2
    held = {i for r in read.select("ids").collect() for i in np.frombuffer(r.ids, dtype=np.int64).tolist()}
    best = {rows[i][0] for a in range(len(ids)) for i in np.flatnonzero((scores[:, a] >= fifth[a]) & (np.array([r[1] for r in rows]) == labels[a]))}
    assert best <= held


def test_ranges_hold_all_cells():
    cells = [0, 1, 2, 5, 9, 10, 20]
    assert hard_negatives._ranged(cells, 100) == [(0, 2), (5, 5), (9, 10), (20, 20)]
    assert hard_negatives._ranged(cells, 2) == [(0, 10), (20, 20)] and hard_negatives._ranged([], 2) == []
