"""Every query of the library against DuckDB on the smallest tables."""

import duckdb
import pytest

from quarrylake.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    want = sorted(repr([r[columns.index(c)] for c in order]) for r in found.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in got.collect()) == want
