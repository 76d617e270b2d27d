"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cohortrates.catalog.registry import QUERIES
from tools.compare import compare, rows_of

SF_DIR = Path(entry.SMOKE_DIR)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert all(sql for _, sql in QUERIES.values())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = entry.queries()[name](spark, str(SF_DIR))
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(entry.oracle_sql()[name])
    wanted = rows_of([c[0] for c in result.description], result.fetchall())
    assert compare(found, wanted) == "ok"
