"""SimHash groups, decontamination and licence scans against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortrates.llm import decontaminate, license_scan, simhash
from cohortrates.llm.common import settled

from .conftest import prose


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps: list[int], bits: int) -> dict[int, int]:
    nodes = sorted(set(fps))
    label = {f: f for f in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if (a ^ b).bit_count() <= bits and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("bits", [2, 12])
def test_groups_match_plain_version(docs, rows, bits):
    got = Counter(map(tuple, simhash.near_duplicates(docs, bits=bits).collect()))
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_classes(fps, bits)
    ids: dict[int, list] = {}
    for (i, _), f in zip(rows, fps, strict=True):
        ids.setdefault(label[f], []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    assert got == Counter((i, f"{f:016x}", least[label[f]]) for (i, _), f in zip(rows, fps, strict=True))


def test_tree_loses_no_pair_over_boundaries(spark):
    """A small tree of small shards over fingerprints in chains, so that most links lie over a boundary."""
    rng = random.Random(3)
    fps = []
    for _ in range(150):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 25)):
            fps.append(f)
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    signed = np.array(sorted(set(fps)), dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    edges = simhash.links(nodes, 2, sample=600, shard=40)
    assert edges.count() < 20 * len(signed)
    root = {r.u: r.root for r in simhash.components(edges).collect()}
    label = plain_classes([f & (2**64 - 1) for f in signed], 2)
    groups: dict[int, set] = {}
    for f in signed:
        groups.setdefault(label[f & (2**64 - 1)], set()).add(f)
    assert all(root.get(f, f) == min(g) for g in groups.values() for f in g)


def test_shards_are_bounded_whatever_the_number_of_fingerprints(spark):
    """From a small sample, with a third of all fingerprints in one ball that no vantage point splits."""
    rng = np.random.default_rng(2)
    bits = np.uint64(1) << rng.integers(0, 64, (8000, 3), dtype=np.uint64)
    ball = np.uint64(0x0123456789ABCDEF) ^ bits[:, 0] ^ bits[:, 1] ^ bits[:, 2]
    points = np.unique(np.concatenate([ball, rng.integers(0, 1 << 64, 14_000, dtype=np.uint64, endpoint=False)]))
    points = np.unique(np.concatenate([points, points[::7] ^ np.uint64(6)]))
    nodes = spark.createDataFrame([(f,) for f in points.view(np.int64).tolist()], "fp long").repartition(4)
    most, shard = simhash.OVER * 200, 200
    dealt = settled(simhash.sharded(nodes, 2, sample=256, shard=shard), "test-shards")
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert max(sizes) <= most and dealt.select("fp").distinct().count() == len(points)
    edges = simhash.links(nodes, 2, sample=256, shard=shard)
    root = {r.u: r.root for r in simhash.components(edges).collect()}
    first = simhash.classes(points)
    signed = points.view(np.int64)
    least: dict[int, int] = {}
    for f, c in zip(signed.tolist(), first.tolist(), strict=True):
        least[c] = min(f, least.get(c, f))
    assert all(root.get(f, f) == least[c] for f, c in zip(signed.tolist(), first.tolist(), strict=True))


def test_dense_shard_is_compared_whole():
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    dense = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(3000)}
    points = np.array(sorted(dense), dtype=np.uint64)
    first = simhash.classes(points)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    seen = {0}
    waiting = [0]
    while waiting:
        for j in np.flatnonzero(near[waiting.pop()]).tolist():
            if j not in seen:
                seen.add(j)
                waiting.append(j)
    assert set(np.flatnonzero(first == 0).tolist()) == seen


def test_components_of_long_chains(spark):
    chain = [(i + 1, i) for i in range(200)] + [(1000, 1001), (1001, 1001), (1005, 1000)]
    got = {r.u: r.root for r in simhash.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000, 1005: 1000}


def test_one_of_each_group_stays(docs, no_docs):
    kept = simhash.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    groups = simhash.grouped(docs).select("root").distinct().count()
    assert kept.count() == groups
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(100) == 1 and not any(i in ids for i in range(101, 112)) and ids.count(209) == 1
    assert simhash.keep_one(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    words = text.split()
    for _ in range(int(len(words) * share)):
        k = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[k : k + 1] = [["changed"], [], [words[k], "inserted"]][kind] or []
    return " ".join(words)


@pytest.fixture(scope="module")
def items(spark):
    data = [(i, prose(5000 + i, 25 + i)) for i in range(12)] + [(50, None), (51, ""), (52, "?!"), (12, prose(5003, 28)), (None, "unnamed item of a few rare words")]
    return spark.createDataFrame([(i, t, "x") for i, t in data], "item_id long, text string, similarity string")


def test_copies_are_found_and_clean_texts_left(spark, items):
    passage = {i: prose(5000 + i, 25 + i) for i in range(12)}
    data = [(i, f"{prose(i, 100)} {passage[i % 12].upper()}. {prose(i + 50, 100)}") for i in range(24)]
    data += [(100 + i, f"{prose(i, 300)}\n{edited(passage[i], i, 0.2)}\n{prose(i + 90, 50)}") for i in range(12)]
    data += [(200 + i, prose(9000 + i, 400)) for i in range(40)] + [(300, None), (301, ""), (None, passage[1]), (302, "unnamed item, of a few RARE words")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in data], "doc_id long, text string, score double")
    found = decontaminate.contaminated(docs, items).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    want = {(i, i % 12) for i in range(24)} | {(100 + i, i) for i in range(12)} | {(None, 1), (302, None)}
    want |= {(i, 12) for i, j in want if j == 3}
    assert pairs == want
    assert all(r.similarity == 1 for r in found if r.doc_id is not None and r.doc_id < 24)
    kept = decontaminate.remove_contaminated(docs, items)
    assert kept.schema.names == docs.schema.names
    assert sorted(r.doc_id for r in kept.collect()) == [*range(200, 240), 300, 301]


def test_edited_copies_are_found_as_by_full_alignment(spark):
    """Lone copies with 15 to 30 % of the words edited, and edited ones beside verbatim ones, against full alignment."""
    items = {i: prose(7000 + i, 15 + i % 40) for i in range(60)} | {60: " ".join(f"step{k}" for k in range(70))}
    rng = random.Random(11)
    texts = {}
    for i in range(60):
        share = (0.15, 0.2, 0.3)[i % 3]
        copy = edited(items[i], i, share) if i % 2 else " ".join("other" if rng.random() < share else w for w in items[i].split())
        texts[i] = f"{prose(8000 + i, 70)} {copy} {prose(9000 + i, 70)}"
    items |= {70: " ".join(f"rule{k}" for k in range(30))}
    fifth = " ".join("other" if k % 5 == 4 else w for k, w in enumerate(items[70].split()))
    texts |= {100 + k: items[70] for k in range(4)} | {200: fifth, 201: prose(1, 300)}
    # nearly twice as long as its item, with all seeds at the beginning
    texts |= {202: " ".join(w + (" and" if k > 3 else "") for k, w in enumerate(items[60].split()))}
    hashed, own = ({i: np.array([decontaminate.word_hash(w) for w in decontaminate.words_of(t)], dtype=np.uint64) for i, t in side.items()} for side in (texts, items))
    seeds, theirs = ({i: set(decontaminate.gram_hashes(h, decontaminate.NGRAM).tolist()) for i, h in side.items()} for side in (hashed, own))
    want = {}
    for i, j in ((i, j) for i in texts for j in items if seeds[i] & theirs[j]):
        score = decontaminate.align(hashed[i], own[j])[0]
        if score / (2 * len(own[j])) >= decontaminate.SIMILARITY:
            want[i, j] = score
    assert {(200, 70), (202, 60)} <= want.keys() and len(want) > 50
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.score for r in found} == want


def hashed_words(texts: dict) -> dict:
    return {i: np.array([decontaminate.word_hash(w) for w in decontaminate.words_of(t)], dtype=np.uint64) for i, t in texts.items()}


def test_recall_against_alignment_without_seeds(spark):
    """Copies with 15 to 40 % of the words edited, and with every third word replaced, among texts of the same words."""
    items = {i: prose(7000 + i, 12 + i % 45) for i in range(90)}
    rng = random.Random(3)
    texts = {}
    for i, item in items.items():
        words, share = item.split(), (0.15, 0.25, 0.33, 0.4)[i % 4]
        for k, copy in enumerate(
            [edited(item, i, share), " ".join("other" if rng.random() < share else w for w in words), " ".join("other" if j % 3 == i % 3 else w for j, w in enumerate(words))]
        ):
            texts[1000 * k + i] = f"{prose(8000 + 3 * i + k, 40)} {copy} {prose(9000 + 3 * i + k, 40)}"
    texts |= {5000 + i: prose(100 + i, 120) for i in range(60)}
    theirs, own = hashed_words(texts), hashed_words(items)
    want = set()
    for i, j in ((i, j) for i in theirs for j in own):
        if np.isin(own[j], theirs[i]).mean() >= 0.5 and decontaminate.align(theirs[i], own[j])[0] >= len(own[j]):
            want.add((i, j))
    assert len(want) > 180 and sum(i >= 2000 for i, _ in want) > 60
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert found <= want and len(found) >= 0.95 * len(want)


def stages_of(spark, docs, items):
    """Passages, units and seeds as ``contaminated`` makes them."""
    own = decontaminate.item_words(items)
    units = settled(own.groupBy("a", "b").agg(F.first("words").alias("words")).select(F.monotonically_increasing_id().alias("unit"), "words", F.size("words").alias("n")), "test-units")
    grams = settled(decontaminate.unit_seeds(units), "test-seeds")
    seeds = settled(grams.join(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("items")), "gram"), "test-counts")
    found = decontaminate.passages(docs, units, seeds).withColumn("passage", F.monotonically_increasing_id())
    return settled(found, "test-passages"), units, seeds


def test_pairs_grow_in_proportion_where_items_begin_alike(spark):
    """Every text holds the words that all items begin with, and every tenth one the end of one more item."""
    begin = "which of the following statements about the subject is"
    made = {}
    for n in (100, 200):
        ends = [" ".join(f"end{i * 31 + k}" for k in range(12)) for i in range(4 * n)]
        items = spark.createDataFrame([(i, f"{begin} {ends[i]}") for i in range(n)], "item_id long, text string")
        docs = spark.createDataFrame([(i, f"{prose(600 + i, 20)} {begin} {ends[i // 10] if i % 10 == 0 else prose(300 + i, 20)}") for i in range(4 * n)], "doc_id long, text string")
        found, units, seeds = stages_of(spark, docs, items)
        assert found.count() == 4 * n
        made[n] = decontaminate.candidates(found, units, seeds).count()
    assert 40 <= made[100] <= 200 and made[200] <= 2.5 * made[100]


def test_items_that_differ_in_little_are_told_apart_by_longer_seeds(spark):
    """Each item shares all seeds of its first words with all others; copies are verbatim or edited behind them."""
    begin = " ".join(f"shared{k}" for k in range(30))
    items = {i: f"{begin} only{i} tail{i} end{i}" for i in range(100)}
    texts = {i: f"{prose(i, 10)} {items[i]} {prose(50 + i, 10)}" for i in range(0, 100, 9)}
    texts |= {500: f"{begin} and so on", 501: f"{prose(1, 20)} shared3 shared4 shared5 {prose(2, 20)}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.contaminated(docs, frame).collect()
    exact = {(r.doc_id, r.item_id) for r in found if r.similarity == 1}
    assert exact == {(i, i) for i in range(0, 100, 9)}
    long_seeds = decontaminate.lengthened(*stages_of(spark, docs, frame)[1:])
    assert long_seeds.groupBy("unit").count().count() == 100 and long_seeds.agg(F.max("size")).first()[0] <= 33


def test_very_long_items_and_texts(spark):
    item = " ".join(f"w{k}" for k in range(3000))
    data = [(1, f"{prose(1, 50)} {item} {prose(2, 50)}"), (2, " ".join(f"w{k}" for k in range(0, 3000, 2))), (3, prose(3, 60_000)), (4, "w1 w2 w3 w4")]
    items = spark.createDataFrame([(1, item), (2, "w1 w2 w3 w4")], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(data, "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 2), (4, 2)]


def test_frequent_copies_keep_their_seeds(spark):
    """A passage in every document is as frequent as any of its n-grams, and is found in all."""
    data = [(i, f"{prose(i, 30)} the rain in spain stays mainly in the plain today {prose(i + 500, 30)}") for i in range(60)]
    items = spark.createDataFrame([(1, "The rain in Spain stays mainly in the plain today")], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(data, "doc_id long, text string"), items)
    assert sorted((r.doc_id, r.similarity) for r in found.collect()) == [(i, 1.0) for i in range(60)]


def test_decontamination_takes_empty_tables(docs, no_docs, items):
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.remove_contaminated(docs, items.limit(0)).count() == docs.count()


def plain_alignment(a: list[int], b: list[int]) -> int:
    score = np.zeros((len(b) + 1, len(a) + 1), dtype=int)
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            hit = score[i - 1, j - 1] + (2 if a[j - 1] == b[i - 1] else -1)
            score[i, j] = max(0, hit, score[i - 1, j] - 1, score[i, j - 1] - 1)
    return int(score.max())


def test_alignment_matches_plain_table():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(1, 15))]
        score, begin, end = decontaminate.align(np.array(a), np.array(b))
        assert score == plain_alignment(a, b)
        if score:
            assert begin < end and plain_alignment(a[begin:end], b) == score


def test_licences_and_inheritance(spark):
    text = dict(license_scan.TEMPLATES)
    data = [
        (1, "/p/LICENSE", text["Apache-2.0"]),
        (2, "/p/a/b/code.py", "# nothing said"),
        (3, "/p/a/LICENSE.md", text["GPL-3.0"]),
        (4, "p/a/b/c.py", "x = 1"),
        (5, "/p/a/d.py", "# Released under the MIT License.\nimport os"),
        (6, "/q/e.py", "text about a river license of some other kind entirely"),
        (7, "/q/f.py", None),
        (8, None, "Licensed under CC BY-NC 4.0."),
        (9, "/p/g.py", "LICENSED under the Apache license, version 2.0!"),
        (9, "/p/g.py", "LICENSED under the Apache license, version 2.0!"),
        (10, "/r/h.py", prose(4, 5000) + "\nLicensed under CC BY-SA 4.0\n" + prose(5, 5000)),
        (None, "/p/a/LICENSES-not/i.py", ""),
    ]
    files = spark.createDataFrame([(i, p, t, 0) for i, p, t in data], "doc_id long, path string, text string, unit int")
    got = Counter((r.doc_id, r.license, r.how, r.licensed_by) for r in license_scan.scan(files).collect())
    assert got == Counter(
        [
            (1, "Apache-2.0", "own", None), (2, "GPL-3.0", "inherited", "p/a"), (3, "GPL-3.0", "own", None), (4, "GPL-3.0", "inherited", "p/a"),
            (5, "MIT", "own", None), (6, None, "none", None), (7, None, "none", None), (8, "CC-BY-NC-4.0", "own", None),
            (9, "Apache-2.0", "own", None), (9, "Apache-2.0", "own", None), (10, "CC-BY-SA-4.0", "own", None), (None, "GPL-3.0", "inherited", "p/a"),
        ]
    )
    assert license_scan.scan(files.limit(0)).count() == 0


def test_licences_inside_lines(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", dict(license_scan.TEMPLATES[:3])["MIT"]
    long = license_scan.TEMPLATES[4][1]
    data = [
        (1, f"{prose(1, 24)} {apache}", "Apache-2.0"),
        (2, f"Source code for Zebra harvester tool. {apache}", "Apache-2.0"),
        (3, f"{prose(2, 400)} {apache} {prose(3, 400)}", "Apache-2.0"),
        (4, f"{prose(4, 50)} {mit} {prose(5, 50)}", "MIT"),
        (5, f"{prose(6, 30)} students of the MIT need a license to drive {prose(7, 30)}", None),
        (6, f"{prose(8, 30)} // {long[:90]}\n// {long[90:]} {prose(9, 30)}", "Apache-2.0"),
        (7, f"{prose(10, 30)} the license of a shop, a licensed trade, copyright of songs {prose(11, 30)}", None),
        (10, "SPDX-License-Identifier: MIT", "MIT"),
        (11, "/* SPDX-License-Identifier: Apache-2.0 */ int main(void) { return run(); }", "Apache-2.0"),
        (12, "# spdx-license-identifier: GPL-3.0-only", "GPL-3.0"),
        (13, "# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", "GPL-2.0"),
        (14, "# SPDX-License-Identifier: (ISC OR BSD-3-Clause)", "BSD-3-Clause"),
        (15, "# SPDX-License-Identifier: BSD-2-Clause", None),
        (16, f"{prose(12, 30)} SPDX-License-Identifier: CC0-1.0. {prose(13, 30)}", "CC0-1.0"),
    ]
    files = spark.createDataFrame([(i, f"/f/{i}", t) for i, t, _ in data], "doc_id long, path string, text string")
    assert {r.doc_id: r.license for r in license_scan.scan(files).collect()} == {i: name for i, _, name in data}
