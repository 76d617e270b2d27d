"""Quality rules, line deduplication and the quality classifier against plain versions."""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from cohortrates.llm import line_dedup, quality_classifier, quality_rules
from cohortrates.llm.common import shared_folder

from .conftest import prose

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_statistics(text: str | None) -> tuple:
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    n = len(words)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_statistics_match_plain_count(docs, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules.judge(docs).select("doc_id", *names, "kept").collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter((i, *plain_statistics(t)) for i, t in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_rules_agree_with_sql(spark, docs):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = Counter(map(tuple, quality_rules.judge(docs).select(*names).collect()))
    documents = docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"})
    with duckdb.connect() as con:
        con.register("documents", documents)
        want = con.sql(quality_rules.oracle_sql()).select(", ".join(names)).fetchall()
    assert got == Counter(want)


def test_estimation_finds_what_rules_are_worth(spark):
    """Two rules see the same faults; a third votes by chance."""
    data = [(1, 1, i % 2) for i in range(800)] + [(0, 0, i % 2) for i in range(150)] + [(0, -1, 1)] * 20
    rules = [quality_rules.Rule(n, "true", "false") for n in ("a", "b", "c")]
    found = quality_rules.fit(spark.createDataFrame(data, "vote_a int, vote_b int, vote_c int"), rules)
    assert found.prior == pytest.approx(0.82, abs=0.03)
    assert found.on_good[0] > 0.98 and found.on_bad[0] > 0.98
    assert 0.4 < found.on_good[2] < 0.6 and 0.35 < found.on_bad[2] < 0.6


def test_rules_take_no_rows(no_docs):
    assert quality_rules.judge(no_docs).count() == 0


def plain_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def plain_dedup(rows: list[tuple], least: int, chars: int = 1) -> list[tuple]:
    found = Counter(k for _, t in rows for k in {plain_key(x) for x in (t or "").split("\n")} if len(k) >= chars)
    made = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if found[plain_key(x)] < least]
        made.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return made


@pytest.mark.parametrize(("least", "chars"), [(2, 1), (10, 1), (10, 20), (13, 1)])
def test_line_dedup_matches_plain_version(docs, rows, least, chars):
    got = Counter(map(tuple, line_dedup.dedup_digest(docs, least, chars).collect()))
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain_dedup(rows, least, chars))


def test_line_dedup_keeps_columns_and_rows(docs, rows, no_docs):
    cleaned = line_dedup.dedup_lines(docs)
    assert cleaned.schema.names == docs.schema.names
    want = Counter((i, t, len(t), 1, 2.0) for i, _, _, t in plain_dedup(rows, line_dedup.MIN_DOCUMENTS))
    assert Counter(map(tuple, cleaned.select("doc_id", "text", "n_chars", "n_words", "_k").collect())) == want
    assert line_dedup.dedup_lines(no_docs).count() == 0 and line_dedup.dedup_digest(no_docs).count() == 0


def test_runs_compact_and_survive_a_restart(spark):
    folder = shared_folder(spark, "test-runs")
    runs = line_dedup.LineRuns(spark, folder, min_documents=3)
    keys = [[(1, 1), (2, 2)], [(1, 1), (3, 3)], [(1, 1), (2, 2), (4, 4)], [(2, 2), (1, 1)], [(4, 4), (5, 5)]]
    for batch in keys[:3]:
        runs.add(spark.createDataFrame(batch, "a long, b long"))
    assert runs.levels[1] and len(runs.levels[0]) == 1
    again = line_dedup.LineRuns.load(spark, folder, min_documents=3)
    assert (again.levels, again.shared, again.version) == (runs.levels, runs.shared, 3)
    assert {tuple(r) for r in again.shared_keys().collect()} == {(1, 1)}
    for batch in keys[3:]:
        again.add(spark.createDataFrame(batch, "a long, b long"))
    assert {tuple(r) for r in again.shared_keys().collect()} == {(1, 1), (2, 2)}


def test_batches_meet_runs_where_they_lie(spark):
    """One exchange deals the batch; shared keys, runs and merges need none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = line_dedup.LineRuns(spark, shared_folder(spark, "test-runs"), min_documents=4, fanout=3)
        for i in range(5):
            batch = spark.range(300).selectExpr(f"id % 90 + {20 * i} AS a", "id % 90 AS b")
            counted = runs.counted(batch)
            counted.collect()
            plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == (2 if i else 0)
            runs.add(batch)
        assert sum(map(len, runs.levels.values())) > 2
        merged = runs._held([n for names in runs.levels.values() for n in names])
        assert merged.count() > 0 and "Exchange hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_damaged_manifest_is_an_error_and_an_unfinished_one_is_not_read(spark):
    folder = shared_folder(spark, "test-runs")
    assert line_dedup.LineRuns.load(spark, folder).version == 0
    runs = line_dedup.LineRuns(spark, folder, min_documents=2)
    runs.add(spark.createDataFrame([(1, 1)], "a long, b long"))
    runs.add(spark.createDataFrame([(1, 1)], "a long, b long"))
    (Path(folder) / "manifest" / "v=2" / "_SUCCESS").unlink()
    before = line_dedup.LineRuns.load(spark, folder, min_documents=2)
    assert before.version == 1 and before.shared_keys().count() == 0
    for part in (Path(folder) / "manifest" / "v=1").glob("*part-*"):
        part.write_bytes(b"no table at all") if part.suffix == ".parquet" else part.unlink()
    with pytest.raises(Exception, match="parquet|Parquet|magic"):
        line_dedup.LineRuns.load(spark, folder)


def test_batches_double():
    assert line_dedup.batch_shares(0) == [] and line_dedup.batch_shares(5, 8) == [1.0]
    assert line_dedup.batch_shares(100, 10) == [0.1, 0.3, 0.7, 1.0]


def test_line_dedup_in_many_batches(docs, rows):
    lines, shared = line_dedup.shared_lines(docs, 3, 1, first=5)
    assert lines.select("batch").distinct().count() > 3
    found = Counter(k for _, t in rows for k in {plain_key(x) for x in (t or "").split("\n")} if k)
    assert shared.count() == sum(n >= 3 for n in found.values()) == shared.distinct().count()


def junk(i: int) -> str:
    kinds = [lambda t: t.replace(" ", "### "), lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", " | "), lambda t: f"{t.split()[0]} " * 90]
    return kinds[i % 4](prose(i, 80))


@pytest.fixture(scope="module")
def labelled(spark):
    data = [(i, prose(i, 80 + i % 60) if i % 4 else junk(i // 4)) for i in range(400)]
    extra = [(1000, None), (1001, ""), (1001, ""), (None, prose(3, 50))]
    docs = spark.createDataFrame(data + extra, "doc_id long, text string")
    marks = [(i, int(i % 4 > 0), 0) for i in range(400) if i % 3] + [(1, 1, 0), (None, 1, 0), (2, None, 0), (9999, 0, 0)]
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(labelled):
    got = quality_classifier.score_documents(*labelled).collect()
    assert len(got) == 404 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 60 and sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark, labelled):
    docs, labels = labelled
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert sorted(map(str, quality_classifier.score_documents(docs, labels).collect())) == sorted(map(str, quality_classifier.score_documents(docs, turned).collect()))


def test_classifier_keeps_columns_and_takes_no_rows(docs, no_docs, labelled):
    _, labels = labelled
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.schema.names == docs.schema.names
    scores = Counter(r.doc_id for r in quality_classifier.score_documents(docs, labels).collect() if r.predicted)
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == scores
    assert quality_classifier.score_documents(no_docs, labels.limit(0)).count() == 0
    assert quality_classifier.score_documents(docs, labels.limit(0)).count() == docs.count()
