"""Each registered query against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(table):
    names = sorted(table.column_names)
    key = lambda r: tuple((v is None, "" if v is None else str(v)) for v in r)
    return names, sorted((tuple(r[c] for c in names) for r in table.to_pylist()), key=key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = rows(QUERIES[name](spark, DATA).toArrow())
    if name in SQL:
        assert got == rows(db.sql(SQL[name]).to_arrow_table())
    else:
        assert got[1]


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["qid", "answer", "found"]
