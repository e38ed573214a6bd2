"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from stratalake.workload.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
    assert rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    cursor = db.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    got = ordered(tuple(r[c] for c in columns) for r in frame.collect())
    assert got == ordered(cursor.fetchall())
