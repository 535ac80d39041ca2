"""Every registered query equals its SQL on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from beatloom.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] if r[i] != 0 else 0 for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = canonical(result.fetchall(), columns)
    assert canonical(df.collect(), df.columns) == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 5
