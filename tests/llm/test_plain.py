"""The quality classifier and the licence matcher against plain versions in numpy and dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortrates.llm import license_scan, quality_classifier
from cohortrates.llm.license_scan import TEMPLATES, terms_of

from .conftest import prose
from .test_filters import junk


def test_scores_are_those_of_a_plain_discriminant(spark):
    data = [(i, prose(i, 60 + i % 90) if i % 3 else junk(i)) for i in range(240)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    marks = {i: int(i % 3 > 0) for i in range(240) if i % 5}
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks.items()], "doc_id long, quality int, toxic int")
    names = [f"f_{n}" for n in quality_classifier.FEATURES]
    rows = {r.doc_id: np.array([r[n] for n in names]) for r in quality_classifier.features(docs, ["doc_id"]).collect()}
    train = {q: np.array([rows[i] for i in marks if marks[i] == q and zlib.crc32(str(i).encode()) % 4 != 2]) for q in (0, 1)}
    n = sum(map(len, train.values()))
    means = {q: x.mean(0) for q, x in train.items()}
    scatter = {q: (x - means[q]).T @ (x - means[q]) for q, x in train.items()}
    common = (scatter[0] + scatter[1]) / n + 1e-6 * np.eye(len(names))
    pooled, sphere = quality_classifier.POOLED, quality_classifier.SPHERE
    cov = {
        q: (1 - pooled - sphere) * scatter[q] / len(train[q]) + pooled * common + sphere * np.trace(common) / len(names) * np.eye(len(names)) for q in (0, 1)
    }

    def density(x: np.ndarray, q: int) -> float:
        gap = x - means[q]
        return math.log((len(train[q]) + 1) / (n + 2)) - 0.5 * (gap @ np.linalg.inv(cov[q]) @ gap + np.linalg.slogdet(cov[q])[1])

    found = quality_classifier.score_documents(docs, labels).collect()
    assert len(found) == len(data)
    for r in found:
        far = density(rows[r.doc_id], 0) - density(rows[r.doc_id], 1)
        assert r.score == pytest.approx(1 / (1 + math.exp(min(500, max(-500, far)))), rel=1e-6, abs=1e-12)
    assert {r.predicted for r in found} == {0, 1}


def plain_matches(units: list[str]) -> dict[str, tuple[str, float]]:
    shapes = [(name, Counter(terms_of(text))) for name, text in TEMPLATES]
    total = len(units) + len(shapes)
    df = Counter(t for u in units for t in set(u.split(" "))) + Counter(t for _, terms in shapes for t in terms)

    def weights(terms: Counter) -> dict[str, float]:
        return {t: (1 + math.log(n)) * (math.log((1 + total) / (1 + df[t])) + 1) for t, n in terms.items()}

    def size(w: dict[str, float]) -> float:
        return math.sqrt(sum(x * x for x in w.values()))

    sides = [(name, weights(terms)) for name, terms in shapes]
    made = {}
    for u in set(units):
        own = weights(Counter(u.split(" ")))
        scored = [(-round(sum(x * w.get(t, 0.0) for t, x in own.items()) / (size(own) * size(w)), 9), name) for name, w in sides if own.keys() & w.keys()]
        if scored:
            far, name = min(scored)
            made[u] = (name, -far)
    return made


def test_matches_are_those_of_a_plain_cosine(spark):
    words = [" ".join(terms_of(text)) for _, text in TEMPLATES]
    units = words + words[:3] * 4 + [" ".join(w.split(" ")[: 3 + k]) for k, w in enumerate(words)] + [f"{w} and some more {k}" for k, w in enumerate(words)]
    units += ["license", "license"] * 20 + ["of the", "nothing known here", prose(4, 12).lower()]
    found = license_scan.matched_units(spark.createDataFrame([(u,) for u in units], "unit string").repartition(5)).collect()
    wanted = plain_matches(units)
    assert len(found) == len(wanted) > 20
    for r in found:
        assert r.similarity == pytest.approx(wanted[r.unit][1], abs=2e-9) and (r.license == wanted[r.unit][0] or abs(r.similarity - wanted[r.unit][1]) < 2e-9)
